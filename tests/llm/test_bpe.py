import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tallyroom.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(bpe.read_ranks(PATH), PATTERN)


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_same_ids_as_the_library_on_random_texts(own, theirs):
    pick = random.Random(5)
    alphabet = "ab cdeZ.,!?'\n\t  \x1c\x85\xa0　漢字éß12 3—'s're\U0001f642\r​ "
    texts = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == theirs.encode_ordinary(text), repr(text)
        assert own.decode(ids.tolist()) == text.encode()


@pytest.mark.parametrize("text", [
    "a" * 3000, "ab" * 700, "é" * 1000, " " * 500, "word " * 3, " \n" * 40 + "x", "z" * 300 + ".", "", "<|endoftext|>"])
def test_long_and_odd_words(own, theirs, text):
    assert next(own.encode([text])).tolist() == theirs.encode_ordinary(text)


def test_forgetting_parts_changes_nothing(theirs):
    small = bpe.Encoder(bpe.read_ranks(PATH), PATTERN)
    small.parts.limit = 3
    texts = ["one two three four, five.", "six seven\neight nine, ten", "one  two\n\nthree"]
    assert [i.tolist() for i in small.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_nulls_empty_repeated_rows_and_clashing_columns(spark, theirs):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello, world", "x"), (3, "Hello, world", "x"), (None, "a\tb", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    out = bpe.digests(frame, PATH, PATTERN).collect()
    assert len(out) == 5
    for row, (doc, text, _) in zip(out, rows, strict=True):
        ids = theirs.encode_ordinary(text or "")
        assert tuple(row) == (doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                              hashlib.sha256((text or "").encode()).hexdigest())
    assert bpe.digests(frame.limit(0), PATH, PATTERN).count() == 0
    trip = bpe.decoded(bpe.encoded(frame, PATH, PATTERN), PATH, PATTERN).collect()
    assert [bytes(r["decoded"]).decode() for r in trip] == [t or "" for _, t, _ in rows]
