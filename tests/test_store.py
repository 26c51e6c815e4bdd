import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyroom.operators import tables
from tallyroom.plans import summary_store
from tallyroom.schemas import OPERATIONAL
from tallyroom.sinks import store

COMPUTED = ("user_id long, document_id long, method string, mode string, target_language string, summary_hash string, "
            "summary_text string, key_insights string, hierarchy_json string, cached boolean")
NOW, LATER = "2024-02-01T00:00:00", "2024-03-01T00:00:00"


def computed(frame, *requests):
    made = frame(COMPUTED, *[(u, d, "tfidf", "brief", "en", None, text, "[]", "{}", False) for u, d, text in requests])
    return tables.with_summary_key(made).select(*[c.split()[0] for c in COMPUTED.split(", ")])


def test_store_again_and_read_back(spark, frame, tmp_path):
    path = tmp_path / "summaries"
    assert summary_store.read_summaries(spark, path).isEmpty()
    summary_store.store_summaries(path, computed(frame, *[(u, d, f"first {u} {d}") for u in range(5) for d in range(8)]), F.lit(NOW), buckets=8)
    first = {(r["user_id"], r["document_id"]): r for r in summary_store.read_summaries(spark, path).collect()}
    assert len(first) == 40 and len({r["id"] for r in first.values()}) == 40
    summary_store.store_summaries(path, computed(frame, (1, 1, "second"), (9, 9, "new")), F.lit(LATER), buckets=3)
    second = {(r["user_id"], r["document_id"]): r for r in summary_store.read_summaries(spark, path).collect()}
    assert len(second) == 41
    changed = second.pop((1, 1))
    assert (changed["id"], changed["created_at"], changed["summary_text"]) == (first[1, 1]["id"], "2024-02-01T00:00:00", "second")
    added = second.pop((9, 9))
    assert added["id"] > max(r["id"] for r in first.values()) and added["created_at"] == "2024-03-01T00:00:00"
    assert all(first[k] == r for k, r in second.items())


def test_quiz_rows_follow_what_is_stored_again(spark, frame, tmp_path):
    path = tmp_path / "summaries"
    quiz = frame("id long, user_id long, document_id long, summary_cache string", (1, 1, 1, None), (2, 9, 9, "own"), (3, 1, 2, None))
    summary_store.store_summaries(path, computed(frame, (1, 1, "first")), F.lit(NOW))
    before = summary_store.read_summaries(spark, path)
    updates = tables.new_summary_rows(computed(frame, (1, 1, "second"), (9, 9, "new")), F.lit(100), F.lit(LATER))
    got = summary_store.update_quiz_rows(quiz, before, updates)
    assert sorted(rows(got, "id", "summary_cache"), key=str) == [(1, "second"), (2, "own"), (3, None)]


def test_requests_are_computed_once(spark, frame, tmp_path):
    text = "Binary search halves a sorted list again and again until it ends. " * 6
    documents = frame("id long, text_content string", (1, text), (2, text))
    asked = frame("user_id long, document_id long, method string, mode string, target_language string",
                  (7, 1, "auto", "brief", "en"), (7, 1, "hybrid", "brief", "en"), (7, 2, "tfidf", "brief", "en"))
    answers = [sorted(rows(summary_store.answer_and_store(asked, documents, tmp_path / "s", F.lit(NOW)), "document_id", "method", "summary_text", "cached"))
               for _ in range(2)]
    assert [r[:3] for r in answers[0]] == [r[:3] for r in answers[1]]
    assert {r[3] for r in answers[0]} == {False} and {r[3] for r in answers[1]} == {True}
    assert summary_store.read_summaries(spark, tmp_path / "s").count() == 2 and len(store.versions(spark, tmp_path / "s")) == 1


def keyed(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v long")


def newest(stored, updates):
    new = updates.groupBy("k").agg(F.max("v").alias("n"))
    return stored.join(new, stored["k"].eqNullSafe(new["k"]), "full").select(
        F.coalesce(stored["k"], new["k"]).alias("k"), F.coalesce("n", "v").alias("v"))


def test_many_merges_equal_a_dictionary(spark, tmp_path):
    pick, expected = random.Random(4), {}
    for step in range(6):
        pairs = [(pick.choice([None, "", *"abcdefghij"]) if step else f"k{i}", 10 * step + i % 7) for i in range(30 if not step else 6)]
        store.upsert(tmp_path, keyed(spark, pairs), "k", newest, buckets=5)
        for k in {k for k, _ in pairs}:
            expected[k] = max(v for other, v in pairs if other == k)
        got = rows(store.read_store(spark, tmp_path, "k string, v long"))
        assert len(got) == len(expected) and dict(got) == expected
    assert store.versions(spark, tmp_path) == list(range(6))
    store.drop_old_versions(spark, tmp_path, keep=1)
    assert store.versions(spark, tmp_path) == [5] and dict(rows(store.read_store(spark, tmp_path, "k string, v long"))) == expected
    store.upsert(tmp_path, keyed(spark, [("z", 1)]), "k", newest)
    assert dict(rows(store.read_store(spark, tmp_path, "k string, v long"))) == expected | {"z": 1}


def test_only_touched_buckets_are_rewritten_and_a_failed_merge_changes_nothing(spark, tmp_path):
    store.upsert(tmp_path, keyed(spark, [(str(i), i) for i in range(200)]), "k", newest, buckets=16)
    store.upsert(tmp_path, keyed(spark, [("5", 99)]), "k", newest)
    assert len(list((tmp_path / "data" / "v1").glob("bucket=*"))) == 1 and len(list((tmp_path / "data" / "v0").glob("bucket=*"))) == 16

    def broken(stored, updates):
        return updates.withColumn("v", F.raise_error(F.lit("no")).cast("long"))

    with pytest.raises(Exception):
        store.upsert(tmp_path, keyed(spark, [("6", 0)]), "k", broken)
    assert store.versions(spark, tmp_path) == [0, 1]
    got = dict(rows(store.read_store(spark, tmp_path, "k string, v long")))
    assert got["5"] == 99 and got["6"] == 6 and len(got) == 200
    assert dict(rows(store.read_store(spark, tmp_path, "k string, v long", version=0)))["5"] == 5
    with pytest.raises(FileNotFoundError):
        store.read_store(spark, tmp_path, "k string, v long", version=7)


def test_summary_columns_are_the_table_s(frame):
    assert [f.name for f in OPERATIONAL["summaries"]] == tables.new_summary_rows(computed(frame, (1, 1, "x")), F.lit(1), F.lit(NOW)).columns
