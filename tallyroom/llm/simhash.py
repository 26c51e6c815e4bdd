"""Near-duplicates by SimHash: fingerprints linked by a self-join of a binary trie.

A fingerprint has 64 bits; bit b is set if over half of the shingle hashes have it.
Two fingerprints link if at most `budget` bits differ. Of budget + 1 equal blocks of
bits one then agrees, so every distinct fingerprint is dealt once for each block, by
the value of that block (the rotated fingerprint's leading bits). Each task holds one
range of leading bits, sorted, which is a binary trie, and walks pairs of trie nodes
from the root down: differing bits add up and a pair is dropped once they exceed the
budget. What it emits is a forest of the links found, not all pairs of a dense group.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .shared import components, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
#: Node pairs that are walked at once; more wait on a stack, so memory stays bounded.
FRONTIER = 50_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the text's shingles: A-Z lower-cased, repeats counted; no word gives 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # long texts in blocks
        block = hashes[start:start + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprint(documents: DataFrame, text: str = "text", shingle: int = 3, name: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def marks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in batch], np.uint64)
            yield pd.Series(values.view(np.int64))

    return documents.withColumn(name, marks(F.col(text)))


def _turned(values: np.ndarray, bits: int) -> np.ndarray:
    """Rotated to the left."""
    return values if bits == 0 else (values << np.uint64(bits)) | (values >> np.uint64(BITS - bits))


def _span(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the ones of `bit` begin inside each node [lo, hi) of the sorted values."""
    shift = np.uint64(bit)
    target = ((values[lo] >> shift) | np.uint64(1)) << shift
    return np.clip(np.searchsorted(values, target), lo, hi)


def trie_links(values: np.ndarray, lead: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct values that agree in `lead` bits and differ in at most `budget`.

    Walks node pairs of the binary trie. A node is a range of the sorted values; a
    pair of two single values is settled at once by counting bits.
    """
    size = len(values)
    if size < 2:
        return
    start = (np.array([0]), np.array([size]), np.array([0]), np.array([size]), np.array([0]))
    waiting = [(BITS - 1, start)]
    while waiting:
        bit, (alo, ahi, blo, bhi, err) = waiting.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            waiting.append((bit, tuple(x[half:] for x in (alo, ahi, blo, bhi, err))))
            alo, ahi, blo, bhi, err = (x[:half] for x in (alo, ahi, blo, bhi, err))
            waiting.append((bit, (alo, ahi, blo, bhi, err)))
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            left, right = alo[single], blo[single]
            apart = values[left] ^ values[right]
            near = (left < right) & (np.bitwise_count(apart) <= budget)
            if lead:
                near &= apart >> np.uint64(BITS - lead) == 0
            if near.any():
                yield left[near], right[near]
            alo, ahi, blo, bhi, err = (x[~single] for x in (alo, ahi, blo, bhi, err))
        if not len(alo) or bit < 0:
            continue
        amid, bmid = _span(values, alo, ahi, bit), _span(values, blo, bhi, bit)
        same = alo == blo
        step = 0 if BITS - 1 - bit < lead else 1
        # Equal bits cost nothing; unequal bits cost one, and are forbidden in the leading block.
        children = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err)]
        if step:
            children.append((alo, amid, bmid, bhi, err + 1))
            children.append(tuple(x[~same] for x in (amid, ahi, blo, bmid, err + 1)))
        merged = [np.concatenate(x) for x in zip(*children, strict=True)]
        alive = (merged[1] > merged[0]) & (merged[3] > merged[2]) & (merged[4] <= budget)
        alive &= ~((merged[0] == merged[2]) & (merged[1] - merged[0] == 1))  # one value alone
        if alive.any():
            waiting.append((bit - 1, tuple(x[alive] for x in merged)))


def forest(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index reachable from each index."""
    root = np.arange(size)
    for left, right in pairs:
        while True:
            a, b = root[left], root[right]
            open_ = a != b
            if not open_.any():
                break
            left, right, a, b = left[open_], right[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                higher = root[root]
                if (higher == root).all():
                    break
                root = higher
    return root


def fingerprint_links(distinct: DataFrame, name: str = "fingerprint", budget: int = 3) -> DataFrame:
    """(a, b) links between distinct fingerprints: their closure equals that of all links within the budget.

    A task's work is bounded by its share of leading bits: a block of 16 bits has 65,536
    values, dealt by hash over the shuffle partitions.
    """
    blocks = budget + 1
    width = BITS // blocks

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        for block, group in rows.groupby("block"):
            turn = int(block) * width
            values = np.unique(_turned(group["value"].to_numpy(np.int64).view(np.uint64), turn))
            root = forest(len(values), trie_links(values, width, budget))
            back = _turned(values, BITS - turn if turn else 0).view(np.int64)
            moved = np.flatnonzero(root != np.arange(len(values)))
            yield pd.DataFrame({"a": back[moved], "b": back[root[moved]]})

    dealt = distinct.select(F.col(name).alias("value")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    ).withColumn(
        "lead", F.shiftrightunsigned(F.expr(f"shiftleft(value, block * {width})"), BITS - width)
    )
    return dealt.repartition("block", "lead").select("value", "block").mapInPandas(linked, "a long, b long")


def grouped(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = 3, shingle: int = 3) -> DataFrame:
    """One row per input row: the id, its fingerprint (16 hex digits) and the component's smallest id.

    NULL and empty texts have fingerprint zero and link like any other. Rows with a NULL id
    belong to components but never name one; a component of such rows alone has a NULL id.
    Repeated rows are each returned. An empty table gives no row. Other columns are ignored.
    """
    marked = stored(with_fingerprint(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")),
                                     "__text", shingle).select("doc_id", "fingerprint"))
    named = named_components(marked, budget)
    return marked.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def named_components(marked: DataFrame, budget: int = 3, by: str = "doc_id") -> DataFrame:
    """(fingerprint, component_id) for each distinct fingerprint of `marked`; `by` names the smallest value."""
    distinct = stored(marked.groupBy("fingerprint").agg(F.min(by).alias("first")))
    roots = components(fingerprint_links(distinct, "fingerprint", budget), "a", "b")
    rooted = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.select("fingerprint", "root").join(names, "root").select("fingerprint", "component_id")


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", budget: int = 3, shingle: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays.

    Rows are numbered in a written copy, so repeated rows and NULL ids also leave one row
    (rows without an id yield to rows with one). Columns and their names stay as they are.
    """
    columns = documents.columns
    copy = stored(with_fingerprint(documents, text, shingle, "__fingerprint").withColumn(
        "__row", F.monotonically_increasing_id()))
    order = F.struct(F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("d"), F.col("__row").alias("r"))
    marked = copy.select(F.col("__fingerprint").alias("fingerprint"), F.col("__row"), order.alias("order"))
    named = named_components(marked, budget, "order")
    # Written first: Spark then knows its size, and sends it to the texts where it is small enough.
    dropped = stored(marked.join(named, "fingerprint").where(F.col("component_id.r") != F.col("__row")).select("__row"))
    return copy.join(dropped, "__row", "left_anti").select(*[F.col(f"`{c}`") for c in columns])
