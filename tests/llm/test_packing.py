import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyroom.llm import packing, queries
from tallyroom.llm.parts import ByteLevel, Remembered

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return own


def check(rows, ids_of, window):
    """Every id lies in one piece, sequences have no gap, and only powers of two are short."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        whole = ids_of[r["doc_id"]]
        assert r["doc_tokens"] == len(whole)
        assert zlib.crc32(whole[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    for own in [*sequences.values()]:
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window
    assert sorted(sequences) == list(range(len(sequences)))
    for doc, own in pieces.items():
        assert sorted(x for start, length in own for x in range(start, start + length)) == list(range(len(ids_of[doc])))
    assert set(pieces) == set(ids_of)


def test_whole_tables(spark, tokenizer):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    rows = packing.packed(frame, lambda: ByteLevel(PATH, public_tokenizers.PATTERN), "test").collect()
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in texts.items()}
    check(rows, ids, 2048)


def test_nulls_empty_texts_and_one_length_only(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, "a b  c\n\nd"), (4, "<|endoftext|> x")] + [(i, "w " * 39) for i in range(5, 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("text", "t").selectExpr("*", "1 as length", "2 as cuts")
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in rows}
    out = packing.packed(frame, lambda: ByteLevel(PATH, public_tokenizers.PATTERN), "test", text="t", window=64).collect()
    check(out, ids, 64)
    assert packing.packed(frame.limit(0), lambda: ByteLevel(PATH, public_tokenizers.PATTERN), "test", text="t").count() == 0


def test_added_tokens_are_as_in_an_unmodified_tokenizer(spark):
    pick, plain = random.Random(7), Tokenizer.from_file(PATH)
    bits = ["<|endoftext|>", "<|endoftext|", "<|", "|>", "endoftext", " ", "  ", "\n", "\t", "\u00a0", "a", "Word", "é", "don't", "12", ".", "\U0001f642"]
    texts = ["<|endoftext|>", "a  <|endoftext|>  b", "x\n <|endoftext|>\ny", "<|endoftext|><|endoftext|>."]
    texts += ["".join(pick.choice(bits) for _ in range(pick.randint(1, 30))) for _ in range(400)]
    rows = list(enumerate(texts))
    ids = {d: np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4") for d, t in rows}
    assert len(ids[0]) == 2
    check(queries.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), ids, 2048)


@pytest.mark.parametrize("seed", range(6))
def test_plans_never_take_more_than_there_is(seed):
    pick = np.random.default_rng(seed)
    counts = np.zeros(257, np.int64)
    for length in pick.integers(1, 256, 3 + 60 * seed):
        counts[length] += pick.integers(1, 200)
    slots, used, windows, solved = packing.plan(counts, 256)
    assert (used <= counts).all() and 0 <= solved <= windows
    fill, ranks = np.zeros(windows, int), defaultdict(list)
    for length, first, repeats, begin, _ in slots:
        fill[begin:begin + repeats] += length
        ranks[length].append((first, repeats))
    assert (fill == 256).all()
    for length, own in ranks.items():
        at = 0
        for first, repeats in sorted(own):
            assert first == at
            at += repeats
        assert at == used[length]


def test_least_squares_finds_an_exact_mixture():
    counts = np.zeros(65, np.int64)
    counts[40], counts[24], counts[16], counts[32] = 300, 200, 100, 100
    combos = packing.combinations(counts, 64)
    x = packing.repeat_counts(combos, counts)
    made = np.bincount(combos.ravel(), ((combos > 0) * x[:, None]).ravel(), 65)
    assert np.abs(made[1:] - counts[1:]).sum() < 0.35 * counts.sum()


def test_fast_encoding_gives_the_library_s_ids(spark):
    """Every distinct word of the given documents, and mixtures of hard characters, alone and with a space in front."""
    pick, plain = random.Random(11), Tokenizer.from_file(PATH)
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    words = {w for t in texts for w in t.split()} | {"".join(pick.choice("aeé'ſßłʼ0²½µªΩж漢_$-.~­ɏɐ \n\t…–“€\u00a0\u2028") for _ in range(pick.randint(1, 9))) for _ in range(20_000)}
    parts = [w for w in words] + [" " + w for w in words]
    own = ByteLevel(PATH, public_tokenizers.PATTERN)
    texts = [" ".join(parts[i:i + 7]) for i in range(0, len(parts), 7)] + parts
    expected = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch_fast(texts, add_special_tokens=False)]
    assert list(own.of_texts(texts)) == expected
    assert list(ByteLevel(PATH, public_tokenizers.PATTERN, added=True).of_texts([None, "", "a<|endoftext|>"])) == [
        b"", b"", np.array([64, 50256], "<u4").tobytes()]


def test_parts_are_remembered_within_bounds():
    known = Remembered(10, 4)
    for start in range(0, 60, 3):
        keys = {"often", *(str(x) for x in range(start, start + 3))}
        new = known.missing(keys)
        known.update(dict.fromkeys(new, b""))
        assert keys <= known.keys() and len(known) <= 13
        assert start == 0 or "often" not in new


def test_most_windows_are_the_solved_counts(spark):
    """The histogram of the given documents, and a larger one of the same kind."""
    own = ByteLevel(PATH, public_tokenizers.PATTERN, added=True)
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    lengths = np.array([(len(ids) // 4 + 1) % 2048 for ids in own.of_texts(texts)])
    counts = np.bincount(lengths, minlength=2049)
    _, _, windows, solved = packing.plan(counts, 2048)
    assert solved > windows / 2
    spread = np.random.default_rng(1).integers(-40, 41, 10 * len(lengths)) + np.tile(lengths, 10)
    _, _, windows, solved = packing.plan(np.bincount(np.clip(spread, 1, 2047), minlength=2049), 2048)
    assert solved > 0.7 * windows
