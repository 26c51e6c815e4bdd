"""Byte-level BPE: encoding by padded matrices of equal-length words, and decoding.

The distinct words of a batch are sorted into buckets by length and laid out as
matrices of token ids, one word a row. In each round every row looks up the rank of
all its neighbouring pairs in a hash table, merges its leftmost pair of the lowest
rank and closes the gap; rows without a pair that can merge leave the matrix.
"""

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .parts import WHITE, Parts
from .shared import kept

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of more bytes merge through a heap instead of a matrix row; the merges are the same.
LONG_WORD = 256
#: The rank of what cannot merge.
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class PairTable:
    """Rank of each mergeable pair of ids, by open addressing over a power of two of slots."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 24 | right] = rank
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE)
        self.reach = 0
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs))
        slots = self._slot(keys)
        while len(keys):
            free = self.keys[slots] == -1
            _, first = np.unique(slots[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.keys[slots[placed]], self.ranks[slots[placed]] = keys[placed], values[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (len(self.keys) - 1)
            self.reach += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE where a pair can't merge (a negative right id is padding)."""
        keys = left.astype(np.int64) << 24 | right
        out = np.full(keys.shape, NONE)
        at = np.flatnonzero(right >= 0)
        slots = self._slot(keys[at])
        for _ in range(self.reach):
            if not len(at):
                break
            there = self.keys[slots]
            hit = there == keys[at]
            out[at[hit]] = self.ranks[slots[hit]]
            more = ~hit & (there != -1)
            at, slots = at[more], (slots[more] + 1) & (len(self.keys) - 1)
        return out


class Encoder:
    """Encodes words by ranks. Ids are ranks; a word that is a token itself is one id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.bytes < 0).any():
            raise ValueError("the ranks lack single bytes")
        self.byte_pairs = self.pairs.rank(np.repeat(self.bytes, 256), np.tile(self.bytes, 256))
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(
            r"\S", f"[^{WHITE}]"))
        self.parts = Parts(self.encode_parts)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word as 32-bit integers."""
        out: list = [None] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            whole = self.ranks.get(word)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(word) > LONG_WORD:
                out[i] = self._long(word)
            else:
                buckets.setdefault(-(-len(word) // 4) * 4, []).append(i)
        for width, members in buckets.items():
            step = max(1, (1 << 18) // width)  # rows of a matrix: bounded memory
            for start in range(0, len(members), step):
                rows = members[start:start + step]
                for i, ids in zip(rows, self._matrix([words[i] for i in rows], width), strict=True):
                    out[i] = ids
        return out

    def _matrix(self, words: list[bytes], width: int) -> list[bytes]:
        flat = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        padding = np.arange(width) >= lengths[:, None]
        ids = self.bytes[flat]
        ids[padding] = -1
        ranks = self.byte_pairs[flat[:, :-1].astype(np.int32) << 8 | flat[:, 1:]]
        ranks[padding[:, 1:]] = NONE
        done: list = [None] * len(words)
        rows = np.arange(len(words))
        while True:
            every = np.arange(len(rows))
            at = ranks.argmin(axis=1) if ranks.shape[1] else every * 0  # the leftmost of the lowest
            ended = ranks[every, at] == NONE if ranks.shape[1] else every == every
            if ended.any():
                lines = ids[ended]
                ends = np.arange(len(lines)) * lines.shape[1] * 4 + (lines >= 0).sum(axis=1) * 4
                flat, line = lines.tobytes(), 4 * lines.shape[1]
                for i, (row, end) in enumerate(zip(rows[ended].tolist(), ends.tolist(), strict=True)):
                    done[row] = flat[i * line:end]
                alive = ~ended
                rows, ids, ranks, at = rows[alive], ids[alive], ranks[alive], at[alive]
                every = np.arange(len(rows))
            if not len(rows):
                return done
            ids[every, at] = ranks[every, at]
            # Every row is one id shorter now, so the matrix loses a column.
            keep = np.ones(ids.shape, bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[every, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            # Only the pairs beside the merged id are new.
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs.rank(ids[left, at[left] - 1], ids[left, at[left]])
            right = np.flatnonzero(at < ranks.shape[1])
            ranks[right, at[right]] = self.pairs.rank(ids[right, at[right]], ids[right, at[right] + 1])

    def _long(self, word: bytes) -> bytes:
        """One very long word: the same merges, found by a heap over a linked list."""
        ids = self.bytes[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        array = np.array(ids)
        first = self.pairs.rank(array[:-1], array[1:])
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        tokens, ranks = self.tokens, self.ranks

        def offer(i: int) -> None:
            if 0 <= i and nxt[i] < n:
                rank = ranks.get(tokens[ids[i]] + tokens[ids[nxt[i]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[nxt[i]]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one side has merged meanwhile
            ids[i], ids[j], nxt[i] = rank, -1, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            offer(prv[i])
            offer(i)
        return np.array([x for x in ids if x >= 0], "<i4").tobytes()

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of each part as 32-bit integers; each match of the pattern is encoded by itself."""
        # A space and letters, or letters alone, are one match; only other parts need the pattern.
        matches = [(p.encode(),) if (p[1:] if p[0] == " " else p).isalpha() else tuple(
            m.encode() for m in self.pattern.findall(p)) for p in parts]
        distinct = list(dict.fromkeys(chain.from_iterable(matches)))
        known = dict(zip(distinct, self.encode_words(distinct), strict=True))
        return [known[m[0]] if len(m) == 1 else b"".join(map(known.__getitem__, m)) for m in matches]

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        return (np.frombuffer(ids, np.uint32) for ids in self.parts.of_texts(texts))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a vocabulary file, built once."""
    return kept(f"bpe:{path}:{pattern}", lambda: Encoder(read_ranks(path), pattern))


def encoded(documents: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Adds the token ids of the whole text as array<int>.

    NULL and empty texts give an empty array. Ids of repeated rows are equal. Other columns,
    whatever their names, pass unchanged.
    """
    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path, pattern)
        for batch in batches:
            yield pd.Series([x.astype(np.int32) for x in own.encode(batch)], dtype=object)

    return documents.withColumn(name, ids(F.col(text)))


def decoded(frame: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the bytes of the ids as binary; NULL ids give NULL, an unknown id raises."""
    @F.pandas_udf("binary")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path, pattern)
        for batch in batches:
            yield pd.Series([None if x is None else own.decode(x.tolist()) for x in batch], dtype=object)

    return frame.withColumn(name, back(F.col(ids)))


def digests(documents: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Round trip of every text: doc_id, n_tokens, SHA-256 of the ids and of the decoded bytes.

    Encodes and decodes in one pass, so neither ids nor bytes leave the worker. NULL counts
    as the empty text; repeated rows are each returned; an empty table gives no row.
    """
    schema = documents.select(F.col(doc_id).alias("doc_id")).schema.add("n_tokens", "long").add(
        "ids_sha256", "string").add("decoded_sha256", "string")

    def trip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path, pattern)
        for batch in batches:
            out = []
            for ids in map(np.ndarray.tolist, own.encode(batch["text"])):
                out.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                            hashlib.sha256(own.decode(ids)).hexdigest()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], **{
                n: [row[k] for row in out] for k, n in enumerate(("n_tokens", "ids_sha256", "decoded_sha256"))}})

    return documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(trip, schema)
