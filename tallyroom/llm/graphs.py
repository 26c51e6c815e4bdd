"""Approximate nearest neighbours by a robust-pruned directed graph in each shard.

Vectors are dealt to shards by a hash of their id, at most about `shard_rows` each, and
every shard has a graph of its own: points are inserted in batches, a greedy search
proposes neighbours, and pruning keeps a neighbour only if no kept one is clearly nearer
to it, so edges stay diverse. A beam search answers each query in each shard, and the
shards' best are merged. Equal vectors are one node with all their ids.
"""

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.skew import ranked
from .shared import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Queries that are searched together, and that a (shard, chunk) task gets at most.
BATCH, CHUNK = 256, 32_768


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not NULL, no NULL or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)  # very small or large components neither vanish nor overflow
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine of float64 arrays; equal rows give equal values whatever the batch."""
    return (a * b).sum(axis=-1) / (np.sqrt((a * a).sum(axis=-1)) * np.sqrt((b * b).sum(axis=-1)))


class Graph:
    """Unit vectors, out-neighbours (-1: none) and the entry point."""

    def __init__(self, unit: np.ndarray, degree: int = 32):
        self.unit = unit
        self.edges = np.full((len(unit), degree), -1, np.int32)
        centre = unit.mean(axis=0)
        self.entry = int((unit @ centre).argmax()) if len(unit) else 0

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` best (ids, similarities) of each query, by walking the graph; -1 where fewer were reached."""
        n = len(queries)
        ids = np.full((n, beam), -1, np.int32)
        near = np.full((n, beam), -np.inf, np.float32)
        opened = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.unit)), bool)
        ids[:, 0], seen[:, self.entry] = self.entry, True
        near[:, 0] = queries @ self.unit[self.entry]
        while True:
            waiting = np.where(opened | (ids < 0), -np.inf, near)
            best = waiting.argmax(axis=1)
            active = np.flatnonzero(waiting[np.arange(n), best] > -np.inf)
            if not len(active):
                return ids, near
            opened[active, best[active]] = True
            around = self.edges[ids[active, best[active]]]
            fresh = (around >= 0) & ~seen[active[:, None], around]
            seen[active[:, None], np.where(fresh, around, self.entry)] = True
            close = np.einsum("nd,nkd->nk", queries[active], self.unit[around])
            close[~fresh] = -np.inf
            all_ids = np.concatenate([ids[active], np.where(fresh, around, -1)], axis=1)
            all_near = np.concatenate([near[active], close], axis=1)
            all_open = np.concatenate([opened[active], np.zeros(around.shape, bool)], axis=1)
            order = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, order, axis=1)
            near[active] = np.take_along_axis(all_near, order, axis=1)
            opened[active] = np.take_along_axis(all_open, order, axis=1)

    def prune(self, points: np.ndarray, candidates: np.ndarray, slack: float) -> np.ndarray:
        """Diverse neighbours of each point: a candidate goes if a kept one is `slack` times nearer to it than the point is."""
        degree = self.edges.shape[1]
        n, width = candidates.shape
        there = (candidates >= 0) & (candidates != points[:, None])
        near = np.where(there, np.einsum("nd,nkd->nk", self.unit[points], self.unit[candidates]), -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        candidates, near = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(near, order, axis=1)
        repeat = np.zeros(candidates.shape, bool)
        by_id = np.argsort(candidates, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(candidates, by_id, axis=1)
        np.put_along_axis(repeat, by_id[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
        alive = (near > -np.inf) & ~repeat
        vectors = self.unit[candidates]
        far = 2 - 2 * near  # squared distance of unit vectors
        out, filled = np.full((n, degree), -1, np.int32), np.zeros(n, np.int64)
        for _ in range(degree):
            first = alive.argmax(axis=1)
            rows = np.flatnonzero(alive[np.arange(n), first])
            if not len(rows):
                break
            chosen = first[rows]
            out[rows, filled[rows]] = candidates[rows, chosen]
            filled[rows] += 1
            between = 2 - 2 * np.einsum("nd,nkd->nk", vectors[rows, chosen], vectors[rows])
            alive[rows] &= slack * between > far[rows]
            alive[rows, chosen] = False
        return out

    def build(self, beam: int, slack: float = 1.3, seed: int = 3) -> "Graph":
        """Inserts all points in random order, in batches that double, with edges back from the chosen neighbours."""
        n, degree = self.edges.shape
        order = np.random.default_rng(seed).permutation(n)
        start, size = 0, 8
        while start < n:
            points = order[start:start + size]
            found, _ = self.search(self.unit[points], beam)
            if start < 4 * degree:  # the first points know each other
                early = np.broadcast_to(order[:start + len(points)], (len(points), start + len(points)))
                found = np.concatenate([found, early.astype(np.int32)], axis=1)
            self.edges[points] = self.prune(points, np.concatenate([found, self.edges[points]], axis=1), slack)
            self._back(points, slack)
            start += len(points)
            size = min(BATCH, size * 2)
        return self

    def _back(self, points: np.ndarray, slack: float) -> None:
        """Adds the edges in the other direction; points whose list is full are pruned again."""
        degree = self.edges.shape[1]
        sources = np.repeat(points, degree)
        targets = self.edges[points].ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        unique, begin, count = np.unique(targets, return_index=True, return_counts=True)
        place = np.arange(len(targets)) - np.repeat(begin, count)
        # One row may get many edges at once; all of them are candidates, in blocks of bounded size.
        extra = np.full((len(unique), count.max(initial=0)), -1, np.int32)
        extra[np.repeat(np.arange(len(unique)), count), place] = sources
        merged = np.concatenate([self.edges[unique], extra], axis=1)
        room = (merged >= 0).sum(axis=1) <= degree
        if room.any():
            packed = np.take_along_axis(merged[room], np.argsort(merged[room] < 0, axis=1, kind="stable"), axis=1)
            self.edges[unique[room]] = packed[:, :degree]
        full = np.flatnonzero(~room)
        for at in range(0, len(full), BATCH):
            rows = full[at:at + BATCH]
            self.edges[unique[rows]] = self.prune(unique[rows], merged[rows], slack)


_INDEX = "shard long, dim int, ids binary, owner binary, vectors binary, edges binary, entry int"


def build_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = 8_192,
                degree: int = 32, beam: int = 64) -> DataFrame:
    """One row per shard with its graph, written to the shared folder. Every usable row is indexed.

    Rows with a NULL id or an unusable vector are left out. Vectors of other lengths form
    shards of their own. A hot vector is spread over shards by id and is one node in each.
    """
    rows = stored(vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & usable(F.col("v"))))
    shards = max(1, -(-rows.count() // shard_rows))

    def make(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        raw = np.array(group["v"].tolist(), np.float64)
        distinct, owner = np.unique(raw, axis=0, return_inverse=True)
        graph = Graph(_unit(distinct), degree).build(beam)
        return pd.DataFrame([{
            "shard": group["shard"].iloc[0], "dim": raw.shape[1], "ids": group["id"].to_numpy(np.int64).tobytes(),
            "owner": owner.astype(np.int32).ravel().tobytes(), "vectors": distinct.tobytes(), "edges": graph.edges.tobytes(),
            "entry": graph.entry}])

    dealt = rows.withColumns({"shard": F.pmod(F.xxhash64("id"), F.lit(shards)), "dim": F.size("v")})
    return stored(dealt.groupBy("shard", "dim").applyInPandas(make, _INDEX))


def search(index: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5,
           beam: int = 96, degree: int = 32) -> DataFrame:
    """The k nearest found of every usable query: query_id, rank, vec_id, score (exact cosine of the original vectors).

    A query meets every shard of its length; a task gets one shard and at most about CHUNK
    queries, and passes on k rows for each. Ties go to the smaller id. Candidates are all
    indexed ids but the query's own; queries with equal id and vector are answered once.
    """
    asked = queries.select(F.col(vec_id).cast("long").alias("query_id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("query_id").isNotNull() & usable(F.col("v"))).distinct()
    asked = stored(asked.withColumn("dim", F.size("v")))
    chunks = max(1, -(-asked.count() // CHUNK))
    shards = [(r["dim"], r["n"]) for r in index.groupBy("dim").agg((F.max("shard") + 1).alias("n")).collect()]
    count = F.lit(0)
    for dim, n in shards:
        count = F.when(F.col("dim") == dim, n).otherwise(count)
    each = asked.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks))).withColumn(
        "shard", F.explode(F.when(count > 0, F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))))
    stock = index.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def find(graphs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        if not len(graphs) or not len(asked):
            return empty
        row = graphs.iloc[0]
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
        owner, ids = np.frombuffer(row["owner"], np.int32), np.frombuffer(row["ids"], np.int64)
        graph = Graph(_unit(vectors), degree)
        graph.edges, graph.entry = np.frombuffer(row["edges"], np.int32).reshape(-1, degree), int(row["entry"])
        # The k + 1 smallest ids of each distinct vector: one may be the query itself.
        by_owner = np.argsort(owner, kind="stable")
        sorted_owner = owner[by_owner]
        place = np.arange(len(owner)) - np.searchsorted(sorted_owner, sorted_owner)
        members = np.full((len(vectors), k + 1), -1, np.int64)
        few = place <= k
        members[sorted_owner[few], place[few]] = ids[by_owner[few]]
        out = []
        batch = max(1, min(BATCH, (1 << 24) // max(1, len(vectors))))
        for at in range(0, len(asked), batch):
            part = asked.iloc[at:at + batch]
            raw = np.array(part["v"].tolist(), np.float64)
            found, _ = graph.search(_unit(raw), min(beam, max(k + 1, len(vectors))))
            score = np.where(found >= 0, cosine(raw[:, None, :], vectors[found]), -np.inf)
            names = np.where(found[:, :, None] >= 0, members[found], -1)
            own = part["query_id"].to_numpy(np.int64)
            names[names == own[:, None, None]] = -1
            flat, values = names.reshape(len(part), -1), np.repeat(score, k + 1, axis=1)
            values = np.where(flat >= 0, values, -np.inf)
            best = np.lexsort((flat, -values), axis=1)[:, :k]
            top, value = np.take_along_axis(flat, best, axis=1), np.take_along_axis(values, best, axis=1)
            good = value > -np.inf
            out.append(pd.DataFrame({"query_id": np.repeat(own, top.shape[1])[good.ravel()], "vec_id": top[good], "score": value[good]}))
        return pd.concat(out, ignore_index=True)

    hits = each.groupBy("shard", "dim", "chunk").cogroup(stock.groupBy("shard", "dim", "chunk"))
    hits = hits.applyInPandas(lambda asked, graphs: find(graphs, asked), "query_id long, vec_id long, score double")
    best = ranked(hits.distinct(), ["query_id"], [F.desc("score"), F.asc("vec_id")], k)
    return best.select("query_id", "rank", "vec_id", "score")
