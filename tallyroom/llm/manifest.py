"""A Merkle manifest of a data set whose parents keep their hash states.

A row's leaf is the hash of its fields. Within a group the leaves stand in order; every
`FAN` consecutive nodes become one parent until one node is left, and the groups' roots
become the data set's root the same way. While a parent is hashed, a copy of the SHA-256
state is kept before each child slot. A changed child is folded by resuming the copy of
its slot with the replacement and the siblings on its right; those on its left are in the
state already and are not hashed again.

Nodes are dealt into blocks of at most `SPAN` neighbours, each the base of a whole subtree,
so a group of any size is climbed in rounds that shrink it by `SPAN`. Only block rows meet
in a task: no group is ever gathered. On the way down a block gets the path above it, one
short row for all of its leaves.
"""

import hashlib
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Children of a parent.
FAN = 3
#: Levels that one round climbs, and the nodes at the base of such a subtree.
HEIGHT = 5
SPAN = FAN ** HEIGHT

_PATH = "array<struct<left string, right string>>"


def field_bytes(value: Column) -> Column:
    """`-` for NULL, else the UTF-8 length of the value as text, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields one behind the other."""
    return F.sha2(F.concat(*map(field_bytes, fields)).cast("binary"), 256)


class Parent:
    """The hash of a run of children, with the state before each of them."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[str]):
        state, self.children, self.states = hashlib.sha256(), children, []
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def folded(self, slot: int, child: str) -> str:
        """The digest with another child in `slot`."""
        state = self.states[slot].copy()
        state.update(child.encode())
        for sibling in self.children[slot + 1:]:
            state.update(sibling.encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> tuple[str, str]:
        """The digests left and right of `slot`."""
        return "".join(self.children[:slot]), "".join(self.children[slot + 1:])


class Step:
    """One parent on the path above a block: the state behind its left siblings, and its right siblings."""

    __slots__ = ("state", "right", "siblings")

    def __init__(self, left: str, right: str):
        self.state, self.right, self.siblings = hashlib.sha256(left.encode()), right.encode(), (left + right).encode()

    def folded(self, child: str) -> str:
        state = self.state.copy()
        state.update(child.encode())
        state.update(self.right)
        return state.hexdigest()


def climb(digests: list[str], size: int) -> list[list[Parent]]:
    """The parents above a block, level by level; `size` nodes of the whole group stand beside the block's on their level."""
    levels = []
    for _ in range(HEIGHT):
        if size <= 1:
            break
        parents = [Parent(digests[i:i + FAN]) for i in range(0, len(digests), FAN)]
        levels.append(parents)
        digests, size = [p.digest for p in parents], -(-size // FAN)
    return levels


def _top(levels: list[list[Parent]], digests: list[str]) -> str:
    return levels[-1][0].digest if levels else digests[0]


def placed(frame: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds `place`, from 0 by `order` within `group`, and the group's `size`.

    Rows are dealt into ranges of (group, order), numbered inside a range, and shifted by the
    counts of the ranges before, so no task holds a group.
    """
    dealt = stored(frame.repartitionByRange(group, *order).withColumn("__range", F.spark_partition_id()))
    per_group = Window.partitionBy(group)
    before = per_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = dealt.groupBy(group, "__range").agg(F.count("*").alias("__n")).select(
        group, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
        F.sum("__n").over(per_group).alias("size"))
    inside = Window.partitionBy(group, "__range").orderBy(*order)
    return dealt.withColumn("__in", F.row_number().over(inside) - 1).join(shifts, [group, "__range"]).withColumn(
        "place", F.col("__before") + F.col("__in")).drop("__range", "__in", "__before")


def _blocks(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """One row per block: `columns` as arrays in the order of the nodes."""
    members = F.sort_array(F.collect_list(F.struct(F.col("place").alias("at"), *columns))).alias("m")
    return stored(nodes.groupBy("g", F.expr(f"place div {SPAN}").alias("block")).agg(
        F.first("size").alias("size"), members).select("g", "block", "size", *(F.col(f"m.{c}").alias(c) for c in columns)))


def _parents_of(blocks: DataFrame, digest: str) -> DataFrame:
    """The nodes that the blocks become: g, place, size, digest."""
    def rise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tops = [_top(climb(list(d), s), list(d)) for d, s in zip(batch[digest], batch["size"], strict=True)]
            yield pd.DataFrame({"g": batch["g"], "place": batch["block"], "size": -(-batch["size"] // SPAN), "digest": tops})

    return stored(blocks.select("g", "block", "size", digest).mapInPandas(rise, "g string, place long, size long, digest string"))


def _paths(nodes: DataFrame) -> DataFrame:
    """Nodes (g, place, size, digest) with their group's `root` and the `path` up to it."""
    if (nodes.agg(F.max("size")).first()[0] or 0) <= 1:
        return nodes.select("g", "place", F.col("digest").alias("root"), F.expr(f"cast(array() as {_PATH})").alias("path"))
    blocks = _blocks(nodes, ["place", "digest"])
    above = _paths(_parents_of(blocks, "digest")).withColumnRenamed("place", "block")

    def descend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for g, places, digests, size, root, path in batch.itertuples(index=False, name=None):
                levels, rest = climb(list(digests), size), [(s["left"], s["right"]) for s in path]
                for i, place in enumerate(places):
                    own = [parents[i // FAN ** (k + 1)].siblings(i // FAN ** k % FAN) for k, parents in enumerate(levels)]
                    out.append((g, place, root, [{"left": a, "right": b} for a, b in own + rest]))
            yield pd.DataFrame(out, columns=["g", "place", "root", "path"])

    return blocks.join(above, ["g", "block"]).select("g", "place", "digest", "size", "root", "path").mapInPandas(
        descend, f"g string, place long, root string, path {_PATH}")


def manifest(rows: DataFrame, fields: list[str], doc_id: str = "doc_id", group: str = "source",
             changed: dict[str, Column] | None = None, where: Column | None = None, proofs: bool = False) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root folded from a changed row.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified and, with `proofs`,
    `proof`: the siblings on the way up, one behind the other. `changed` gives other values of
    fields for rows that meet `where` (a NULL condition is not met); all other rows are folded
    from their own leaf.

    Rows of a group stand by `doc_id` (NULL first), rows with one id by their leaves, so repeated
    rows are neighbours with equal leaves. NULL and empty groups are two groups, NULL first.
    A NULL field and an empty one hash differently; very long texts are hashed inside Spark
    and never reach Python. An empty table gives no row. Other columns play no part, whatever
    their names.
    """
    def leaf(values: dict[str, Column]) -> Column:
        return leaf_hash([values.get(f, F.col(f"`{f}`")) for f in fields])

    own, source = leaf({}), F.col(f"`{group}`").cast("string")
    other = F.when(where if where is not None else F.lit(True), leaf(changed)) if changed else F.lit(None).cast("string")
    leaves = stored(rows.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("g"), F.col(f"`{doc_id}`").alias("doc_id"),
        own.alias("leaf"), other.alias("changed")))
    blocks = _blocks(placed(leaves, "g", ["doc_id", "leaf"]), ["doc_id", "leaf", "changed"])
    above = stored(_paths(_parents_of(blocks, "leaf")))
    subroots = above.groupBy("g").agg(F.first("root").alias("digest"))
    named = stored(placed(subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "digest"), "g", ["name"]))
    tops = _paths(named.drop("name")).join(named.select("place", "name"), "place").select(
        F.col("name").alias("g"), F.col("root").alias("top_root"), F.col("path").alias("top_path"))
    ways = above.withColumnRenamed("place", "block").join(tops, "g")
    id_type = leaves.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # Arrow, so that a NULL id does not turn its block's ids into floats
            out: list[tuple] = []
            for block in batch.to_pylist():
                levels = climb(block["leaf"], block["size"])
                steps = [Step(s["left"], s["right"]) for s in (*block["path"], *block["top_path"])]
                rest = b"".join(s.siblings for s in steps)
                for i, (doc, digest, other) in enumerate(zip(block["doc_id"], block["leaf"], block["changed"], strict=True)):
                    node, proof, at = other or digest, [], i
                    for parents in levels:
                        at, slot = divmod(at, FAN)
                        proof += parents[at].siblings(slot)
                        node = parents[at].folded(slot, node)
                    for step in steps:
                        node = step.folded(node)
                    whole = "".join(proof).encode() + rest
                    out.append((doc, digest, block["subroot"], block["root"], hashlib.sha256(whole).hexdigest(), node,
                                node == block["root"], whole.decode() if proofs else None))
            kinds = [batch.schema.field("doc_id").type.value_type, *[pa.string()] * 5, pa.bool_(), pa.string()]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    found = blocks.join(ways, ["g", "block"]).select(
        "size", "doc_id", "leaf", "changed", F.col("root").alias("subroot"), F.col("top_root").alias("root"), "path", "top_path"
    ).mapInArrow(fold, f"doc_id {id_type}, leaf string, subroot string, root string, proof_sha256 string, "
                        "folded_root string, verified boolean, proof string")
    return found if proofs else found.drop("proof")
