import corpus_pipeline
import pytest

from tallyroom.llm.shared import stored

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame(
        [(90001, None, None, None, None), (90002, "", "en", "s", 0), (None, "12 34", None, "s", 5)],
        docs.schema)
    out = [stored(docs.unionByName(odd))]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], DATA)))
    return out


def test_stages_keep_columns_and_shrink(steps):
    for before, after in zip(steps[:4], steps[1:5], strict=True):
        assert before.columns == after.columns
        assert 0 < after.count() <= before.count()
    assert steps[1].count() > 0.6 * steps[0].count()


def test_rejected_documents_are_gone(steps):
    kept = {r["doc_id"] for r in steps[2].collect()}
    assert not {90001, 90002, None} & kept


def test_secrets_are_gone_and_nothing_else(steps):
    before = {r["doc_id"]: r for r in steps[3].collect()}
    changed = 0
    for row in steps[4].collect():
        old = before[row["doc_id"]]
        assert row["n_chars"] == len(row["text"])
        changed += row["text"] != old["text"]
        assert row["text"] == old["text"] or "[SECRET]" in row["text"]
    assert changed < 0.2 * len(before)


def test_packing_covers_what_is_left(steps):
    left = {r["doc_id"] for r in steps[4].collect()}
    pieces = steps[5].toPandas()
    assert set(pieces["doc_id"]) == left
    assert (pieces.groupby("doc_id")["length"].sum() == pieces.groupby("doc_id")["doc_tokens"].first()).all()


def test_run_is_all_stages(spark, steps):
    assert corpus_pipeline.run(spark, DATA).columns == steps[5].columns
