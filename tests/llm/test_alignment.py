import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tallyroom.llm import alignment, parts, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_tokens(libraries, text):
    """(id, bytes) of both sides from unmodified library calls on the whole text."""
    tokenizer, pieces = libraries
    if not text:
        return [], []
    alphabet = parts.byte_alphabet()
    a = [(i, bytes(alphabet[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode())
         for i in pieces.encode(text)]
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    return a, b


def ends(tokens):
    out, at = [], 0
    for i, data in tokens:
        out.append((at, at + len(data), i))
        at += len(data)
    return out


def brute(libraries, rows):
    """Every column by loops over all pairs of tokens."""
    found, counts = {}, Counter()
    for doc, text in rows:
        a, b = (ends(x) for x in plain_tokens(libraries, text))
        links = [(x[2], y[2]) for x in a for y in b if x[1] == y[1]]
        overlaps = sum(1 for x in a for y in b if x[0] < y[1] and y[0] < x[1])
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, last = [], 0
        for cut in cuts:
            own = [",".join(str(x[2]) for x in side if last < x[1] <= cut) for side in (a, b)]
            groups.append("|".join(own))
            last = cut
        text = ";".join(groups)
        found[doc] = [len(a), len(b), len(groups), len(links), links, hashlib.sha256(text.encode()).hexdigest() if text else "", overlaps]
        counts.update(links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return {doc: (n_a, n_b, n_groups, n_links, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest, overlaps)
            for doc, (n_a, n_b, n_groups, n_links, links, digest, overlaps) in found.items()}


def result(frame):
    return {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"))
            for r in frame.collect()}


HARD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n", "\n\na", "a\n b", "a \n b", "a\r\nb;\r\n", "x\ty", "<|endoftext|> x", "<s> </s>",
    "▁x", "x▁y", "<0x41>", "don't can't we'll", "naïve café", "漢字かな交じり文", "\U0001f642\U0001f643", " a  b", "é",
    "ﬁ Å", "\x00a", "1234567890", "((()))", "etc. U.S.A. i.e., x", "a b", "الكلمة العربية", " ​ ", "antidisestablishmentarianism" * 40,
]


def test_hard_texts_and_counts_over_the_corpus(spark, libraries, monkeypatch):
    pick = random.Random(5)
    bits = ["a", " ", " ", "the", "ing", "\n", "é", "漢", ".", ",", "don't", "12", "\t", "ß", "Word", "  ", "\r\n"]
    rows = list(enumerate(HARD + HARD[:20] + ["".join(pick.choice(bits) for _ in range(pick.randint(1, 60))) for _ in range(150)]))
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as chunk", "1 as links").repartition(3)
    assert result(alignment.aligned(frame, A, B, PATTERN)) == brute(libraries, rows)


def test_whole_table(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect() if len(r[1]) < 4000]
    whole = spark.read.parquet(f"{folder}/documents.parquet").where("length(text) < 4000")
    assert result(alignment.aligned(whole, A, B, PATTERN)) == brute(libraries, rows)
    counted = queries.QUERIES["op11_token_alignment"](spark, folder)
    assert counted.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_repeated_rows_null_ids_and_empty_tables(spark, libraries):
    rows = [(None, "a b"), (None, "a b"), (7, "a c"), (7, "a c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = alignment.aligned(frame, A, B, PATTERN).collect()
    assert len(out) == 4 and {r["doc_id"] for r in out} == {None, 7}
    assert {r["n_links"] for r in out} == {2} and max(r["count_sum"] for r in out) == 6
    assert alignment.aligned(frame.limit(0), A, B, PATTERN).count() == 0


def test_chunks_of_any_size_give_the_same(spark, libraries, monkeypatch):
    rows = [(i, t) for i, t in enumerate(HARD * 3)]
    monkeypatch.setattr(alignment, "BATCH_BYTES", 40)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 90)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(alignment.aligned(frame, A, B, PATTERN)) == brute(libraries, rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), max_size=12), st.integers(0, 3))
def test_overlaps_are_all_pairs_that_share_a_byte(shape, extra):
    """Token frames of one document, cut at random, against every pair."""
    total = sum(a for a, _ in shape) + extra
    cuts = [sorted({min(total, x) for x in np.cumsum([s[k] for s in shape])} | {total}) if total else [] for k in (0, 1)]
    frames = [pd.DataFrame({"doc": [0] * len(c), "id": range(len(c)), "start": [0, *c][:len(c)], "end": c}).astype("int64") for c in cuts]
    expected = {(i, j) for i, x in frames[0].iterrows() for j, y in frames[1].iterrows() if x["start"] < y["end"] and y["start"] < x["end"]}
    pairs = alignment.overlaps(*frames)
    assert len(pairs) == len(expected) and set(zip(pairs["a"], pairs["b"], strict=True)) == expected
