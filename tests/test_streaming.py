import datetime
import json
import os

from conftest import rows

from tallyroom import schemas
from tallyroom.sources import streams
from tallyroom.streaming import metrics


def _drop(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as file:
        for user, stamp, topic, score in records:
            file.write(json.dumps({"user_id": user, "timestamp": stamp, "topic": topic, "action_type": "quiz", "score": score}) + "\n")


FIRST = [("1", "2024-01-01T10:05:00Z", "a", 50.0), ("2", "2024-01-01T10:10:00Z", "a", None), ("1", "2024-01-01T10:20:00Z", "a", 70.0),
         ("3", "2024-01-01T10:59:00Z", None, 70.0)]
SECOND = [("2", "2024-01-01T10:30:00Z", "a", 90.0), ("4", "2024-01-01T11:30:00Z", "b", 10.0)]


def _batch(spark, folder):
    return metrics.topic_metrics(spark.read.schema(schemas.LOG_RECORD).json(folder))


def test_complete_output_equals_batch_across_a_restart(spark, tmp_path):
    source, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    _drop(source, "1.json", *FIRST)
    run = lambda: metrics.start_complete(metrics.topic_metrics(streams.file_stream(spark, source)), out, check, None)
    run().awaitTermination()
    assert sorted(rows(metrics.read_complete(spark, out))) == sorted(rows(_batch(spark, source)))
    _drop(source, "2.json", *SECOND)
    run().awaitTermination()
    got = sorted(rows(metrics.read_complete(spark, out)))
    assert got == sorted(rows(_batch(spark, source)))
    assert (datetime.date(2024, 1, 1), "2024-01-01 10:00:00", "a", "quiz", 70.0, 3, 4, 2, 48.28) in got


def test_windows_are_appended_once_closed_and_late_rows_are_dropped(spark, tmp_path):
    source, out, check = (str(tmp_path / p) for p in ("in", "out", "check"))
    run = lambda: metrics.start_append(
        metrics.windowed_topic_metrics(streams.file_stream(spark, source), "10 minutes"), out, check, None).awaitTermination()
    _drop(source, "1.json", *FIRST)
    run()
    _drop(source, "2.json", *SECOND)
    run()
    _drop(source, "3.json", ("9", "2024-01-01T10:40:00Z", "a", 0.0), ("5", "2024-01-01T14:00:00Z", "b", 20.0))
    run()
    _drop(source, "4.json", ("5", "2024-01-01T15:00:00Z", "b", 20.0))
    run()
    got = {r["event_hour"]: r for r in spark.read.parquet(out).collect()}
    # The rows of 10:00 came in two runs and count once; the row that came after the hour was closed does not.
    assert (got["2024-01-01 10:00:00"]["events"], got["2024-01-01 10:00:00"]["active_users"]) == (4, 2)
    assert got["2024-01-01 10:00:00"]["avg_score"] == 70.0
    # The newest hour stays open.
    assert "2024-01-01 15:00:00" not in got and "2024-01-01 11:00:00" in got


def test_files_per_trigger(spark, tmp_path):
    source = str(tmp_path / "in")
    for i in range(7):
        _drop(source, f"{i}.json", *FIRST)
    query = metrics.start_complete(
        metrics.topic_metrics(streams.file_stream(spark, source, 3)), str(tmp_path / "out"), str(tmp_path / "check"), None)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    assert len([d for d in os.listdir(tmp_path / "out") if d.startswith("batch-")]) == 2
    assert rows(metrics.read_complete(spark, tmp_path / "out"), "events", "active_users") == [(21, 2)]


def test_repeats_inside_the_watermark_are_dropped(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _drop(source, "1.json", *FIRST, *FIRST)
    _drop(source, "2.json", *FIRST)
    query = (metrics.dedup_stream(streams.file_stream(spark, source, 1)).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "check")).option("path", out).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_distinct_forms_agree_on_a_static_frame(spark, tmp_path):
    source = str(tmp_path / "in")
    _drop(source, "1.json", *FIRST, *SECOND)
    records = spark.read.schema(schemas.LOG_RECORD).json(source)
    exact = sorted(rows(metrics.topic_metrics(records)))
    assert exact == sorted(rows(metrics.topic_metrics(records, "approximate")))
    assert exact == sorted(rows(metrics.windowed_topic_metrics(records)))
    assert exact == sorted(rows(metrics.windowed_topic_metrics(records, distinct="approximate")))


def test_trigger_interval_is_passed_on(spark, tmp_path):
    source = str(tmp_path / "in")
    _drop(source, "1.json", *FIRST)
    query = metrics.start_complete(
        metrics.topic_metrics(streams.event_stream(spark, folder=source)), str(tmp_path / "out"), str(tmp_path / "check"), "1 second")
    try:
        query.processAllAvailable()
        assert metrics.read_complete(spark, tmp_path / "out").count() == 1
    finally:
        query.stop()
