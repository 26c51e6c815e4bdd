"""Packing documents into windows by non-negative least squares over a length histogram.

A document's ids are cut at every full window; what is left over is a remainder of
1 to window - 1 ids. Shallow combinations of lengths that fill a window exactly (one,
two or three remainders) are the columns of a least-squares problem whose unknowns are
repeat counts and whose right side is the histogram of remainders. The solution is
rounded by the largest remainders to what is there, exact combinations for what is left
are taken greedily, and the residuals are cut into powers of two, which greedy packing in
descending order lays end to end without a gap. Only the last windows are shorter, and those are powers
of two too, so nothing is padded.

The driver sees the histogram (at most `window` counts) and nothing else. Pieces get
their window by arithmetic on their rank among the pieces of equal length; ranks are
counted inside a task and shifted by the counts of earlier tasks.
"""

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .parts import ByteLevel
from .shared import kept, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lengths that may stand in the middle of a combination of three.
MIDDLES = 48
ROUNDS = 400
BATCH_ROWS = 50_000


def pieces(documents: DataFrame, tokenizer: Callable[[], ByteLevel], cache: str, doc_id: str = "doc_id", text: str = "text",
           window: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per full window or remainder of a document, with the CRC-32 of its ids.

    `cuts` holds the CRC-32 of the power-of-two cuts of a remainder, largest first. `task`
    and `place` number the pieces of a length. NULL texts count as empty: one `end_id`. A worker
    makes its `tokenizer` once and keeps it under the name `cache`.
    """
    id_type = documents.select(doc_id).schema[0].dataType.simpleString()
    schema = (f"doc_id {id_type}, start long, length int, ids_crc32 long, doc_tokens long, cuts array<long>, "
              "task int, place long")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, task = kept(cache, tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        last = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch["doc_id"], own.of_texts(batch["text"]), strict=True):
                ids += last
                total, view = len(ids) // 4, memoryview(ids)
                for start in range(0, total, window):
                    length = min(window, total - start)
                    cuts, at = [], start
                    for bit in reversed(range(window.bit_length() - 1)):
                        if length < window and length >> bit & 1:
                            cuts.append(zlib.crc32(view[4 * at:4 * (at + (1 << bit))]))
                            at += 1 << bit
                    crc = zlib.crc32(view[4 * start:4 * (start + length)])
                    out.append((doc, start, length, crc, total, cuts, task, seen[length]))
                    seen[length] += 1
                if len(out) >= BATCH_ROWS:
                    yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])

    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, schema)


def combinations(counts: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths (0: unused) that sum to the window, over lengths that occur."""
    there = np.flatnonzero(counts)
    there = there[(there > 0) & (there < window)]
    if not len(there):
        return np.zeros((0, 3), np.int64)
    pairs = there[(there <= window - there) & (counts[window - there] > 0)]
    found = [np.stack([pairs * 0, pairs, window - pairs], axis=1)]
    # The middle lengths lie evenly among the pieces, so frequent lengths are always there.
    steps = np.cumsum(counts[there])
    middle = np.unique(there[np.searchsorted(steps, np.linspace(1, steps[-1], MIDDLES))])
    a, b = np.repeat(there, len(middle)), np.tile(middle, len(there))
    c = window - a - b
    fits = (c > 0) & (counts[np.clip(c, 0, window)] > 0)
    found.append(np.sort(np.stack([a, b, c], axis=1)[fits], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def repeat_counts(combos: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Non-negative least squares for the repeats of each combination, by multiplicative updates."""
    if not len(combos):
        return np.zeros(0)
    weights = (combos > 0).astype(float)
    target = counts.astype(float)
    target[0] = 0

    def spread(x: np.ndarray) -> np.ndarray:  # A x
        return np.bincount(combos.ravel(), (weights * x[:, None]).ravel(), len(counts))

    def gather(y: np.ndarray) -> np.ndarray:  # transposed A times y
        return (weights * y[combos]).sum(axis=1)

    aim = gather(target)
    x = np.full(len(combos), target.sum() / (3 * len(combos)))
    for _ in range(ROUNDS):
        x *= aim / np.maximum(gather(spread(x)), 1e-12)
    return x


def plan(counts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Windows for remainders: slots (length, first rank, repeats, first window, offset), used ranks, windows.

    `counts[l]` is the number of remainders of length l. Last comes how many of the windows are
    the solved repeat counts; the others are greedy.
    """
    left = counts.astype(np.int64).copy()
    left[0] = left[window] = 0
    slots, used, windows = [], np.zeros(window + 1, np.int64), 0

    def take(combo: list[int], most: int) -> None:
        nonlocal windows
        lengths = [int(x) for x in combo if x]
        repeats = min([most, *(int(left[x]) // lengths.count(x) for x in lengths)])
        if repeats <= 0:
            return
        offset = 0
        for x in lengths:
            slots.append((x, used[x], repeats, windows, offset))
            used[x] += repeats
            left[x] -= repeats
            offset += x
        windows += repeats

    combos = combinations(left, window)
    x = repeat_counts(combos, left)
    whole = np.floor(x).astype(np.int64)
    for i in np.argsort(-x, kind="stable"):
        if whole[i] < 1:
            break
        take(combos[i], int(whole[i]))
    # The rest of the solution, as many windows as its fractions add up to: the largest fractions that still fit.
    due = windows + round(float((x - whole).sum()))
    for i in np.argsort(whole - x, kind="stable"):
        if windows >= due:
            break
        take(combos[i], 1)
    solved = windows
    # What is left: the longest first, with whatever fills the window exactly.
    for length in range(window - 1, window // 3 - 1, -1):
        while left[length]:
            rest = window - length
            small = np.arange(1, rest // 2 + 1)
            both = (left[small] > 0) & (left[rest - small] > 0)
            both &= ~((small == rest - small) & (left[small] < 2))
            both &= ~(((small == length) | (rest - small == length)) & (left[length] < 2))
            both &= ~((small == length) & (rest - small == length) & (left[length] < 3))
            before = windows
            if left[rest] > (rest == length):
                take([length, rest], left[length])
            elif both.any():
                a = int(small[both][-1])
                take([length, rest - a, a], left[length])
            if windows == before:
                break
    return np.array(slots, np.int64).reshape(-1, 5), used, windows, solved


def packed(documents: DataFrame, tokenizer: Callable[[], ByteLevel], cache: str, doc_id: str = "doc_id", text: str = "text",
           window: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces with their sequence and offset: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences are numbered from 0 without a gap; all hold `window` ids but a few last ones,
    which hold a power of two. NULL and empty texts are one id long; repeated rows are packed
    each; an empty table gives no piece. `window` must be a power of two.
    """
    rows = stored(pieces(documents, tokenizer, cache, doc_id, text, window, end_id))
    by_task = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = by_task.withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    counts = np.zeros(window + 1, np.int64)
    for row in rows.groupBy("length").count().collect():  # at most `window` rows
        counts[row["length"]] = row["count"]
    slots, used, windows, _ = plan(counts, window)
    assign = _assigner(counts, slots, used, windows, window)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.join(shifts, ["task", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "cuts", (F.col("place") + F.col("shift")).alias("rank")
    ).mapInPandas(assign, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
                          "sequence_id long, offset long")


def _assigner(counts: np.ndarray, slots: np.ndarray, used: np.ndarray, windows: int, window: int) -> Callable:
    """The function that places pieces by (length, rank): at most a few ten thousand numbers travel with it."""
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    keys = slots[:, 0] << 44 | slots[:, 1]
    first_cut = counts[window] + windows  # sequences: full windows, combinations, then cuts
    rest = np.where(np.arange(window + 1) < window, counts - used, 0)
    rest[0] = 0
    bits = window.bit_length() - 1
    has = (np.arange(window + 1)[None, :] >> np.arange(bits)[:, None]) & 1
    of_bit = has * rest[None, :]
    earlier = np.cumsum(of_bit, axis=1) - of_bit  # cuts of this size from shorter remainders
    sizes = of_bit.sum(axis=1) << np.arange(bits)
    begins = np.cumsum(sizes[::-1])[::-1] - sizes  # ids in all larger cuts
    total = int(sizes.sum())
    edges = np.concatenate([[0], np.cumsum([1 << b for b in reversed(range(bits)) if total % window >> b & 1])]).astype(np.int64)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(np.int64), batch["rank"].to_numpy(np.int64)
            full, cut = length == window, (length < window) & (rank >= used[length])
            sequence, offset = np.where(full, rank, 0), np.zeros(len(batch), np.int64)
            mid = ~full & ~cut
            slot = slots[np.searchsorted(keys, length[mid] << 44 | rank[mid], "right") - 1]
            sequence[mid] = counts[window] + slot[:, 3] + rank[mid] - slot[:, 1]
            offset[mid] = slot[:, 4]
            whole = batch[~cut]
            yield pd.DataFrame({
                "doc_id": whole["doc_id"], "start": whole["start"], "length": length[~cut],
                "ids_crc32": whole["ids_crc32"], "doc_tokens": whole["doc_tokens"],
                "sequence_id": sequence[~cut], "offset": offset[~cut]})
            parts = batch[cut]
            done, nth = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
            crcs = parts["cuts"].to_numpy()
            for bit in reversed(range(bits)):
                on = np.flatnonzero(length[cut] >> bit & 1)
                if not len(on):
                    continue
                lengths, ranks = length[cut][on], rank[cut][on]
                at = begins[bit] + ((earlier[bit, lengths] + ranks - used[lengths]) << bit)
                seq, off = at // window, at % window
                tail = seq == total // window  # the last window is several powers of two
                edge = np.searchsorted(edges, off[tail], "right") - 1
                seq[tail] += edge
                off[tail] -= edges[edge]
                yield pd.DataFrame({
                    "doc_id": parts["doc_id"].iloc[on], "start": parts["start"].to_numpy(np.int64)[on] + done[on],
                    "length": np.full(len(on), 1 << bit), "ids_crc32": [crcs[i][nth[i]] for i in on],
                    "doc_tokens": parts["doc_tokens"].iloc[on], "sequence_id": first_cut + seq, "offset": off})
                done[on] += 1 << bit
                nth[on] += 1

    return place
