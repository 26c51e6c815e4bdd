import itertools

import numpy as np
import pytest
from tallyroom.llm import language


@pytest.mark.parametrize("count", [2, 3, 4, 6, 12, 40])
def test_codewords_differ(count):
    code = language.codewords(count)
    assert set(np.unique(code)) == {-1, 1}
    apart = min((a != b).sum() for a, b in itertools.combinations(code, 2))
    assert apart >= max(1, code.shape[1] // 4)
    assert (np.abs(code.sum(axis=0)) < count).all()


def test_blocks_see_every_gram():
    text = "abc déf " * 20
    whole = np.sort(language.gram_buckets(language._normal(text)))
    old, language.BLOCK = language.BLOCK, 16
    try:
        parts = [language.gram_buckets(d) for _, d in language._blocks([text])]
    finally:
        language.BLOCK = old
    assert set(np.concatenate(parts)) == set(whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    model = language.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1"))
    rows = language.identified(held.withColumnRenamed("text", "t"), model, "t").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts_and_labels(spark):
    frame = spark.createDataFrame(
        [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("no label", None), ("", "de")], "text string, lang string")
    model = language.fit(frame)
    assert model.languages == ("de", "en")
    asked = spark.createDataFrame([(None,), ("",), ("12 !?",), ("the dog",), ("die katze",), ("x" * 300_000,)], "text string").selectExpr("*", "1 as score")
    out = language.identified(asked, model, prefix="p_").collect()
    assert [r["p_lang_pred"] for r in out][:5] == ["und", "und", "und", "en", "de"]
    assert [r["p_score"] for r in out[:3]] == [0, 0, 0] and out[0]["score"] == 1
    none = language.fit(frame.limit(0))
    assert {r["lang_pred"] for r in language.identified(asked, none).collect()} == {"und"}
    single = language.fit(frame.where("lang = 'en'"))
    assert language.identified(asked, single).collect()[3]["lang_pred"] == "en"
