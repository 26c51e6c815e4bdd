import numpy as np
from pyspark.sql import functions as F

from tallyroom.llm import quality

SF = "/root/testdata/sf0.1"


def test_statistics_of_odd_texts(spark):
    frame = spark.createDataFrame([(None,), ("",), (" \n",), ("a a A#\na a A#",)], "text string")
    rows = frame.select(quality.statistics(F.col("text")).alias("s")).select("s.*").collect()
    for row in rows[:3]:
        assert row["n_words"] == row["word_length"] == row["symbols"] == row["stutter"] == 0
    assert rows[3]["n_words"] == 6 and rows[3]["repeated_lines"] == 0.5 and rows[3]["symbols"] == 2 / 13


def test_trees_and_lasso_find_a_conjunction():
    pick = np.random.default_rng(0)
    x = pick.random((3000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] <= 0.4)).astype(float)
    rules = quality.tree_rules(list("abcd"), x, y)
    values = dict(zip("abcd", x.T, strict=True))
    features = np.stack([r.holds(values) for r in rules], axis=1).astype(float)
    w, b = quality.lasso(features, y, 2e-3)
    assert (((features @ w + b) > 0) == y).mean() > 0.97
    assert (w == 0).mean() > 0.3


def test_held_out_accuracy_and_python_agreement(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    joined = docs.join(labels, "doc_id").select("doc_id", "text", "quality").cache()
    model = quality.fit(docs, labels.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"), max_rows=2000)
    assert 0 < len(model.rules) < 200
    held = quality.scored(joined.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"), model)
    rows = held.select("quality", "score", quality.statistics(F.col("text")).alias("s")).select("quality", "score", "s.*").toPandas()
    assert set(quality.NAMES) < set(rows.columns)
    assert ((rows["score"] >= 0.3) == rows["quality"]).mean() > 0.97
    values = {n: rows[n].to_numpy() for n in rows.columns}
    total = model.intercept + sum(r.weight * r.holds(values) for r in model.rules)
    assert np.allclose(rows["score"], 1 / (1 + np.exp(-total)))
    joined.unpersist()


def test_without_labels_or_with_one_label(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, None), (None, "c")], "doc_id long, text string")
    none = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, quality int")
    assert quality.fit(docs, none) == quality.RuleEnsemble((), 0.0)
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    out = quality.scored(docs.selectExpr("*", "1 as n_words", "2 as symbols"), quality.fit(docs, ones)).collect()
    assert all(r["score"] > 0.99 and r["n_words"] == 1 for r in out) and len(out) == 4
    assert quality.scored(docs.limit(0), quality.RuleEnsemble((), 0.0)).count() == 0
