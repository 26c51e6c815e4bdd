"""Aligning the tokens of two tokenizers by the bytes they cover.

Both token sequences of a text cover the same bytes. Per batch of documents two as-of
joins, keyed by document, find for each token start the token of the other side that
covers it. The union of both directions is all overlaps; offsets where tokens of both sides
end cut the text into groups, the smallest stretches that both sides tokenize apart.

Corpus-wide counts of id pairs come from one row per chunk of documents and distinct pair.
A document's links are kept as positions in its chunk's list of pairs, so what is shuffled
for the counts grows with the distinct pairs of chunks, and the totals return to the chunk
as one list.
"""

import hashlib
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from .parts import ByteLevel
from .shared import kept, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of text that are aligned together, and that share a list of pairs.
BATCH_BYTES = 1_000_000
CHUNK_BYTES = 4_000_000
#: Between the tokens of a side, between the sides, between groups.
_COMMA, _BAR, _SEMICOLON = b",|;"


class PieceTokens:
    """A SentencePiece model, which sets a space in front of every text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.own = own = sentencepiece.SentencePieceProcessor(model_file=path)
        names = list(map(own.id_to_piece, range(own.get_piece_size())))
        self.bytes = [bytes([int(n[3:5], 16)]) if own.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def of_texts(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in self.own.encode(texts, num_threads=1)]


class Sides:
    """Both token sequences of texts."""

    def __init__(self, a: str, b: str, pattern: str):
        self.a, self.b = ByteLevel(a, pattern), PieceTokens(b)
        self.lengths = [np.array(list(map(len, side.bytes)), np.int64) for side in (self.a, self.b)]

    def of_texts(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """32-bit ids of both sides; none where text is empty or a side's bytes differ from the text's."""
        def same(ids: bytes, whole: bytes) -> bool:
            return b"".join(map(self.b.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())) == whole

        # A byte-level vocabulary gives every text back; pieces may not, as where a text holds the sign for a space.
        both = zip(texts, self.a.of_texts([" " + t for t in texts]), self.b.of_texts(texts), strict=True)
        return [(a, b) if t and same(b, (" " + t).encode()) else (b"", b"") for t, a, b in both]


def sides(a: str, b: str, pattern: str) -> Sides:
    """The worker's tokenizers, built once."""
    return kept(f"alignment:{a}:{b}", lambda: Sides(a, b, pattern))


def token_frame(ids: list[bytes], lengths: np.ndarray) -> pd.DataFrame:
    """One row per token, in order: doc (position in the list), id, start, end; offsets run on over the documents."""
    tokens = np.frombuffer(b"".join(ids), "<i4")
    ends = np.cumsum(lengths[tokens])
    return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), [len(x) // 4 for x in ids]), "id": tokens,
                         "start": ends - lengths[tokens], "end": ends})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of rows of two token frames whose byte ranges overlap: a, b (positions) and whether they `meet` (end together)."""
    left, right = a[["doc", "start"]].assign(a=np.arange(len(a))), b[["doc", "start"]].assign(b=np.arange(len(b)))
    # The token that covers a start is the last of the other side that starts at it or before.
    from_a = pd.merge_asof(left, right, on="start", by="doc")
    from_b = pd.merge_asof(right, left, on="start", by="doc")
    from_b = from_b[a["start"].to_numpy()[from_b["a"].to_numpy()] < from_b["start"].to_numpy()]  # equal starts are there already
    pairs = pd.concat([from_a[["a", "b"]], from_b[["a", "b"]]], ignore_index=True)
    pairs["meet"] = a["end"].to_numpy()[pairs["a"].to_numpy()] == b["end"].to_numpy()[pairs["b"].to_numpy()]
    return pairs


@lru_cache(4)
def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. most - 1, one number a row, and how many there are."""
    names = np.char.encode(np.arange(most).astype(str))
    return names.view(np.uint8).reshape(most, -1), np.char.str_len(names)


def group_texts(a: pd.DataFrame, b: pd.DataFrame, cuts: np.ndarray, documents: int) -> list[bytes]:
    """Each document's groups as `a1,a2|b1;a3|b2,b3`; `cuts` are the offsets where both sides end."""
    doc = np.concatenate([a["doc"], b["doc"]])
    ids = np.concatenate([a["id"], b["id"]])
    ends = np.concatenate([a["end"], b["end"]])
    side = np.repeat([0, 1], [len(a), len(b)])
    group = np.searchsorted(cuts, ends)
    # Tokens of a side are in order, so a stable sort by (group, side) is all that is needed.
    order = np.argsort(group * 2 + side, kind="stable")
    doc, ids, key = doc[order], ids[order], (group * 2 + side)[order]
    digits, lengths = _digits(1 << int(ids.max()).bit_length() if len(ids) else 1)
    width = digits.shape[1]
    cells = np.empty((len(ids), width + 1), np.uint8)
    cells[:, :width] = digits[ids]
    change = np.ones(len(ids), bool)
    change[:-1] = key[1:] != key[:-1]
    sign = np.where(change, np.where(key & 1, _SEMICOLON, _BAR), _COMMA).astype(np.uint8)
    rows = np.arange(len(ids))
    cells[rows, lengths[ids]] = sign
    flat = cells[np.arange(width + 1) <= lengths[ids][:, None]].tobytes()
    sizes = np.bincount(doc, lengths[ids] + 1, documents).astype(np.int64) if len(ids) else np.zeros(documents, np.int64)
    ends_at = np.cumsum(sizes)
    return [flat[end - size:end - 1] if size else b"" for end, size in zip(ends_at.tolist(), sizes.tolist(), strict=True)]


def _narrow(count: int) -> str:
    return "<u2" if count <= 1 << 16 else "<u4"


class _Chunk:
    """Documents that share a list of pairs."""

    def __init__(self, number: int):
        self.number = number
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: list, texts: list[str], own: Sides) -> None:
        found = own.of_texts(texts)
        a, b = (token_frame([f[k] for f in found], own.lengths[k]) for k in (0, 1))
        pairs = overlaps(a, b)
        met = pairs[pairs["meet"]]
        left, right = np.sort(met["a"].to_numpy()), np.sort(met["b"].to_numpy())  # in order: the n-th ends belong together
        doc = a["doc"].to_numpy()[left]
        groups = group_texts(a, b, a["end"].to_numpy()[left], len(texts))
        n_a, n_b, n_links, n_overlaps = (np.bincount(x, minlength=len(texts)).tolist() for x in (
            a["doc"], b["doc"], doc, a["doc"].to_numpy()[pairs["a"].to_numpy()]))
        at = np.cumsum([0, *n_links])
        links = a["id"].to_numpy()[left].astype(np.int64) << 32 | b["id"].to_numpy()[right]
        for i, doc_id in enumerate(ids):
            digest = hashlib.sha256(groups[i]).hexdigest() if groups[i] else ""
            self.rows.append((doc_id, n_a[i], n_b[i], n_links[i], n_overlaps[i], digest))
            self.pairs.append(links[at[i]:at[i + 1]])
        self.size += sum(map(len, texts))

    def frame(self, names: list[str]) -> pd.DataFrame:
        """The documents' rows, and first a row with the chunk's distinct pairs, the most frequent first, and their counts."""
        chunk = self.number
        distinct, inverse, counts = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        flat, at = place[inverse].astype(_narrow(len(order))), np.cumsum([0, *map(len, self.pairs)])
        head = (chunk, distinct[order], counts[order], *[None] * 7)
        return pd.DataFrame([head] + [(chunk, None, None, *row, flat[at[i]:at[i + 1]].tobytes())
                                      for i, row in enumerate(self.rows)], columns=names).astype(
            {n: "Int64" for n in ("n_a", "n_b", "n_links", "n_overlaps")} | {"doc_id": object})


def aligned(documents: DataFrame, a: str, b: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Alignment figures of each document between the vocabulary file `a` (byte-level, splitting by `pattern`) and the model `b`.

    Returns doc_id, n_a, n_b (tokens), n_groups, n_links (pairs of tokens that end together), n_best (links whose
    pair is as frequent in the corpus as their b id's most frequent pair), count_sum (the links' corpus-wide pair
    counts, added up), groups_sha256, and n_overlaps (pairs of tokens that share a byte).

    NULL and empty texts, and texts that a side does not give back byte by byte, have no tokens: zeros, and an empty
    groups_sha256. Repeated rows count and return once each; ties of the most frequent pair are all best. A text of any
    length is aligned whole, in one batch of its own if it is long. An empty table gives no row. Other columns play no part.
    """
    id_type = documents.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    schema = (f"chunk long, pairs array<long>, counts array<long>, doc_id {id_type}, n_a long, n_b long, n_links long, "
              "n_overlaps long, groups_sha256 string, links binary")
    names = [f.split()[0] for f in schema.split(", ")]

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, ids, texts, size = sides(a, b, pattern), [], [], 0
        chunk = _Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for one, whole in zip(batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None), batch["text"], strict=True):
                ids.append(one)
                texts.append(whole or "")
                size += len(texts[-1])
                if size >= BATCH_BYTES:
                    chunk.add(ids, texts, own)
                    ids, texts, size = [], [], 0
                    if chunk.size >= CHUNK_BYTES:
                        yield chunk.frame(names)
                        chunk = _Chunk(chunk.number + 1)
        if ids:
            chunk.add(ids, texts, own)
        if chunk.rows:
            yield chunk.frame(names)

    rows = stored(documents.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text")).mapInPandas(
        align, schema.replace(f"doc_id {id_type}", "doc_id string")))
    listed = rows.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "p")).select(
        "chunk", "place", F.expr("shiftright(p.pairs, 32)").alias("a"), F.expr("p.pairs & 4294967295").alias("b"), F.col("p.counts").alias("n"))
    totals = listed.groupBy("a", "b").agg(F.sum("n").alias("total"))
    # At most the vocabulary of `a` meets under one b.
    totals = totals.withColumn("best", F.col("total") == F.max("total").over(Window.partitionBy("b")))
    values = listed.join(totals, ["a", "b"]).groupBy(F.col("chunk").alias("of_chunk")).agg(F.sort_array(F.collect_list(F.struct("place", "total", "best"))).alias("v"))
    values = values.select("of_chunk", "v.total", "v.best")
    found = rows.where("pairs is null").drop("pairs", "counts")

    def weigh(keys, documents: pd.DataFrame, values: pd.DataFrame) -> pd.DataFrame:
        total, best = (np.asarray(values[c].iloc[0]) if len(values) else np.zeros(0, np.int64) for c in ("total", "best"))
        places = [np.frombuffer(x, _narrow(len(total))) for x in documents["links"]]
        out = documents[["doc_id", "n_a", "n_b"]].assign(n_groups=documents["n_links"], n_links=documents["n_links"])
        out["n_best"] = [int(best[p].sum()) for p in places]
        out["count_sum"] = [int(total[p].sum()) for p in places]
        return out.assign(groups_sha256=documents["groups_sha256"], n_overlaps=documents["n_overlaps"])

    return found.groupBy("chunk").cogroup(values.groupBy("of_chunk")).applyInPandas(
        weigh, "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
               "groups_sha256 string, n_overlaps long").withColumn("doc_id", F.col("doc_id").cast(id_type))
