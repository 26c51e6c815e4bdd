import datetime

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyroom import schemas
from tallyroom.functions import numbers
from tallyroom.operators import dashboards, gold, silver
from tallyroom.sources.batch import empty_frame

LOG = "user_id string, timestamp string, topic string, action_type string, score double, quiz_id string, metadata map<string,string>"


@pytest.fixture()
def log(frame):
    return frame(
        LOG,
        ("1", "2024-01-01T10:15:00Z", " python ", "quiz", 50.0, "q", None),
        ("1", "2024-01-01T10:59:59+00:00", "python", "quiz", None, None, {"duration_seconds": "30"}),
        ("2", "2024-01-01T23:30:00-05:00", "python", "view", 70.0, None, {"engagement_score": "0.5"}),
        (None, "not a time", None, "view", 10.0, None, {"duration_seconds": "x"}),
        ("3", None, "", "view", 0.0, None, None),
    )


def _empty_tables(spark):
    return {name: empty_frame(spark, schema) for name, schema in schemas.OPERATIONAL.items()}


def test_silver_takes_empty_tables_and_keeps_types(spark, log):
    logs = dict.fromkeys(("quiz", "chat", "activity", "event_lake"), log)
    events = silver.silver_events(logs, _empty_tables(spark))
    assert [(f.name, f.dataType) for f in events.schema] == [(f.name, f.dataType) for f in schemas.SILVER_EVENT]
    assert events.count() == 20
    assert events.where("event_timestamp is null").count() == 8
    late = events.where("user_id = '2'").first()["event_timestamp"]
    assert late == datetime.datetime(2024, 1, 2, 4, 30)


def test_metadata_is_read_only_on_request(log):
    assert rows(silver.log_events(log, "x").agg(F.sum("duration_seconds"), F.sum("engagement_score"))) == [(0, 0.0)]
    got = silver.log_events(log, "x", use_metadata=True)
    assert rows(got.agg(F.sum("duration_seconds"), F.sum("engagement_score"))) == [(30, 0.5)]


def test_same_action_from_two_sources_is_one_event(log):
    both = silver.log_events(log, "quiz_log").union(silver.log_events(log, "event_lake"))
    assert silver.dedup_events(both).count() == 5


def test_table_events_topic(frame):
    events = frame(
        "user_id long, created_at string, topics_json string, activity_type string, event_type string, resource_id string, "
        "duration_seconds long, engagement_score double",
        (7, "2024-01-01T00:00:00Z", '["a","b"]', "x", "y", "1", None, None), (None, "bad", "[]", "x", "y", None, 5, 0.5),
        (8, None, "broken", "x", "y", None, 5, 0.5))
    got = silver.table_events(events).collect()
    assert [r["topic"] for r in got] == ["a", "general", "general"]
    assert got[0]["duration_seconds"] == 0 and got[1]["user_id"] is None


def test_document_word_rule(frame):
    docs = frame("id long, user_id long, text_content string, created_at string, updated_at string",
                 (1, 1, "", "x", None), (2, 1, None, None, None), (3, 1, " two  words ", None, None), (4, 1, "a\n", None, None))
    got = {r["document_id"]: (r["content_characters"], r["content_words"]) for r in silver.silver_documents(docs).collect()}
    assert got == {"1": (0, 1), "2": (None, None), "3": (12, 2), "4": (2, 2)}


def test_topic_metrics(log):
    cube = gold.activity_cube(silver.log_events(log, "x"))
    got = {r["topic"]: r for r in gold.topic_metrics(cube).collect()}
    assert set(got) == {"python", ""}
    python = got["python"]
    assert (python["avg_score"], python["attempts"], python["events"], python["unique_users"]) == (60.0, 2, 3, 2)
    assert python["difficulty_score"] == 55.45
    assert [r["topic"] for r in gold.topic_metrics(cube).collect()] == ["", "python"]


def test_cube_is_independent_of_partitioning(log):
    events = silver.log_events(log, "x")
    a = sorted(rows(gold.topic_metrics(gold.activity_cube(events))))
    b = sorted(rows(gold.topic_metrics(gold.activity_cube(events.repartition(7)))))
    assert a == b


def test_cube_and_single_events_give_the_same_tables(log):
    events = silver.log_events(log, "x")
    for table in (gold.topic_metrics, gold.user_engagement, gold.daily_activity, gold.hourly_activity, gold.recommendation_features):
        assert sorted(map(str, rows(table(gold.measured_events(events))))) == sorted(map(str, rows(table(gold.activity_cube(events)))))


def _cube_of(frame, *counts):
    return frame(
        "user_id string, topic string, event_hour timestamp, event_type string, events long, scored long, score_total double, "
        "score_best double, duration_seconds long, engagement_total double, engagement_rows long",
        *[(str(i), "t", datetime.datetime(2024, 1, 1), "x", n, s, total, None, 0, 0.0, n) for i, (n, s, total) in enumerate(counts)])


def test_engagement_bands_on_the_edge(frame):
    got = gold.user_engagement(_cube_of(frame, (100, 0, None), (99, 0, None), (25, 0, None), (24, 0, None)))
    assert [r["engagement_band"] for r in got.collect()] == ["high", "medium", "medium", "emerging"]


def test_skill_bands_and_revision_flag_on_the_edge(frame):
    cube = _cube_of(frame, (2, 2, 160.0), (2, 2, 159.98), (2, 2, 120.0), (2, 2, 119.98), (2, 0, None), (1, 1, 90.0))
    got = {r["user_id"]: (r["skill_band"], r["recommend_revision"]) for r in gold.recommendation_features(cube).collect()}
    assert got == {"0": ("strong", 0), "1": ("steady", 0), "2": ("steady", 0), "3": ("weak", 1), "4": ("weak", 0), "5": ("strong", 1)}


def test_models(frame, spark):
    cube = _cube_of(frame, *[(n, n, n * (40.0 + n)) for n in range(1, 13)])
    features = gold.recommendation_features(cube)
    clusters = gold.student_clusters(features)
    assert clusters.select("cluster_id").distinct().count() == 3
    assert sorted(rows(clusters)) == sorted(rows(gold.student_clusters(features)))
    predicted = gold.performance_predictions(features)
    assert all(abs(r["predicted_score"] - r["avg_score"]) < 0.5 for r in predicted.collect())
    few = gold.performance_predictions(features.limit(3))
    assert sorted(rows(few, "predicted_score")) == sorted(rows(gold.formula_predictions(features.limit(3)), "predicted_score"))
    assert rows(gold.student_clusters(features.limit(1)), "cluster_id") == [(-1,)]
    assert gold.student_clusters(features.limit(0)).isEmpty()
    assert sorted(rows(gold.performance_predictions(features, "formula"))) == sorted(rows(gold.formula_predictions(features)))
    for table in (gold.performance_predictions, gold.student_clusters):
        with pytest.raises(ValueError):
            table(features, method="other")


def test_number_rules(one):
    assert one(numbers.score_percent(F.lit(4), F.lit(5))) == 80.0
    assert one(numbers.score_percent(F.lit(4), F.lit(0))) == 400.0
    assert [one(numbers.study_minutes(F.lit(w))) for w in (0, 899, 1080, 99999)] == [5, 5, 6, 90]
    assert one(numbers.study_engagement(F.lit(5), F.lit(10))) == 1.0
    assert one(numbers.study_engagement(F.lit(5), F.lit(2000))) == 0.5
    for avg, attempts, level in ((None, 0, "medium"), (85.0, 1, "hard"), (84.99, 1, "medium"), (60.0, 1, "medium"), (59.99, 1, "easy")):
        assert one(numbers.recommended_level(F.lit(avg).cast("double"), F.lit(attempts))) == level


def test_dashboard_prefers_gold(spark, tmp_path, log):
    logs = dict.fromkeys(("quiz", "chat", "activity", "event_lake"), log)
    computed = dashboards.dashboard(spark, tmp_path, logs, 1)
    assert computed["hardest"].first()["events"] == 4
    cube = gold.activity_cube(silver.log_events(log, "x"))
    gold.topic_metrics(cube).write.parquet(str(tmp_path / "topic_metrics"))
    stored = dashboards.dashboard(spark, tmp_path, logs, 1)
    assert stored["hardest"].count() == 1 and stored["weak"].isEmpty()
    assert set(stored) == set(computed) == {"hardest", "weak", "top", "trend", "recommendations"}


def test_dashboard_falls_back_when_the_logs_cannot_be_used(spark, log, tmp_path):
    broken = dict.fromkeys(("quiz", "chat", "activity", "event_lake"), log.drop("topic"))

    def missing():
        raise KeyError("no logs")

    expected = {k: rows(v) for k, v in dashboards.fallback_sections(log, log, 3).items()}
    for logs in (broken, missing):
        with pytest.raises((AnalysisException, KeyError)):
            dashboards.dashboard(spark, tmp_path / "gold", logs, 3)
        got = dashboards.dashboard(spark, tmp_path / "gold", logs, 3, rest=lambda: (log, log))
        assert {k: rows(v) for k, v in got.items()} == expected
    loaded = dashboards.dashboard(spark, tmp_path / "gold", lambda: dict.fromkeys(broken, log), 3, rest=missing)
    assert loaded["hardest"].count() > 0


def test_fallback_variant_keeps_null_groups(log):
    got = dashboards.fallback_sections(log, log)
    assert {r["topic"] for r in got["hardest"].collect()} == {" python ", "python", "general", ""}
    assert (None, None, 10.0, 1) in rows(got["weak"])
    assert [r["user_id"] for r in got["top"].collect()][-1] == "3"
    assert rows(got["trend"], "event_date", "events", "active_users") == [
        (datetime.date(2024, 1, 1), 2, 1), (datetime.date(2024, 1, 2), 1, 1)]
