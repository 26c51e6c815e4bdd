"""Topic metrics of an event stream, per hour, topic and action.

The same functions run on a static frame, which is how batch and stream are kept
equal.
"""

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clocks import hour_label, parse_ts
from ..functions.numbers import difficulty, mean

#: Folder names of the complete table's versions.
VERSION = "batch-"
KEYS = ["event_date", "event_hour", "topic", "action_type"]


def timed_records(records: DataFrame, watermark: str | None = None) -> DataFrame:
    """Records with a parsed event time and a topic; `watermark` bounds the state kept for late data."""
    timed = records.withColumn("event_timestamp", parse_ts(F.col("timestamp")))
    if watermark:
        timed = timed.withWatermark("event_timestamp", watermark)
    return timed.where(F.col("topic").isNotNull())


def _measures(users: Column) -> list:
    return [
        F.sum("score").alias("score_total"), F.count("score").alias("attempts"),
        F.count("*").alias("events"), users.alias("active_users"),
    ]


def _finish(grouped: DataFrame) -> DataFrame:
    return (
        grouped.withColumn("avg_score", mean(F.col("score_total"), F.col("attempts")))
        .withColumn("difficulty_score", difficulty(F.col("avg_score"), F.col("events")))
        .select(*KEYS, "avg_score", "attempts", "events", "active_users", "difficulty_score")
    )


def distinct_users(how: str) -> Column:
    """Distinct users inside one aggregate, in a form streams accept."""
    if how == "exact":
        return F.size(F.collect_set("user_id")).cast("long")
    if how == "approximate":
        return F.approx_count_distinct("user_id")
    raise ValueError("distinct is 'exact' or 'approximate'")


def _exact_by_user(timed: DataFrame, by: list, groups: list) -> DataFrame:
    """Totals with exact users by two chained aggregates: per user, then counted.

    A busy topic is spread over its users instead of growing one set.
    """
    per_user = timed.groupBy(*by, "user_id").agg(
        F.sum("score").alias("total"), F.count("score").alias("scored"), F.count("*").alias("n")
    )
    return per_user.groupBy(*groups).agg(
        F.sum("total").alias("score_total"), F.sum("scored").alias("attempts"),
        F.sum("n").alias("events"), F.count("user_id").alias("active_users"),
    )


def topic_metrics(records: DataFrame, distinct: str = "exact") -> DataFrame:
    """Unbounded form: every group stays open, so results are complete but state only grows.

    For `complete` or `update` output. Rows without a readable time form a group
    with NULL date and hour. Users are exact unless a sketch of fixed size is asked
    for (`approximate`). A stream takes no chained aggregates in these modes, so there
    the exact form keeps one set of users per hour, topic and action.
    """
    ts = F.col("event_timestamp")
    timed = timed_records(records).withColumns({"event_date": F.to_date(ts), "event_hour": hour_label(ts)})
    if not records.isStreaming and distinct == "exact":
        return _finish(_exact_by_user(timed, KEYS, KEYS))
    return _finish(timed.groupBy(*KEYS).agg(*_measures(distinct_users(distinct))))


def windowed_topic_metrics(records: DataFrame, watermark: str = "1 hour",
                           distinct: str = "exact") -> DataFrame:
    """Bounded form: hour windows, emitted once the watermark has passed their end.

    Exact users come from two chained aggregates, which this output mode allows.
    """
    hours = F.window("event_timestamp", "1 hour").alias("window")
    timed = timed_records(records, watermark)
    by, groups = [hours, "topic", "action_type"], ["window", "topic", "action_type"]
    if distinct == "exact":
        grouped = _exact_by_user(timed, by, groups)
    else:
        grouped = timed.groupBy(*by).agg(*_measures(distinct_users(distinct)))
    start = F.col("window.start")
    return _finish(grouped.withColumns({"event_date": F.to_date(start), "event_hour": hour_label(start)}))


def dedup_stream(records: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop repeats of an action that arrive within the watermark."""
    return timed_records(records, watermark).dropDuplicatesWithinWatermark(
        ["user_id", "timestamp", "topic", "action_type", "score"]
    )


def _trigger(writer, trigger):
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


def start_complete(metrics: DataFrame, path, checkpoint, trigger: str | None = "5 seconds"):
    """Keep the complete result as parquet; every batch writes a version of its own.

    `read_complete` reads the newest finished version, so readers never meet a missing or
    half-written table, and a repeated batch replaces its own version only. The version
    before the newest stays for readers that have just opened it; older ones go.
    """
    target = os.fspath(path)

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/{VERSION}{batch_id}")
        for version in _versions(batch.sparkSession, target)[:-2]:
            folder = batch.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{VERSION}{version}")
            folder.getFileSystem(batch.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)

    writer = metrics.writeStream.outputMode("complete").foreachBatch(replace)
    return _trigger(writer.option("checkpointLocation", os.fspath(checkpoint)), trigger).start()


def _versions(spark: SparkSession, target: str) -> list[int]:
    """Finished versions, oldest first."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{VERSION}*/_SUCCESS")
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root) or []
    return sorted(int(f.getPath().getParent().getName().removeprefix(VERSION)) for f in found)


def read_complete(spark: SparkSession, path) -> DataFrame:
    """The newest finished version of a table kept by `start_complete`."""
    versions = _versions(spark, os.fspath(path))
    if not versions:
        raise FileNotFoundError(f"no finished version in {path}")
    return spark.read.parquet(f"{os.fspath(path)}/{VERSION}{versions[-1]}")


def start_append(metrics: DataFrame, path, checkpoint, trigger: str | None = "5 seconds"):
    """Append every closed hour to a parquet table, partitioned by day."""
    writer = metrics.writeStream.outputMode("append").format("parquet").partitionBy("event_date")
    writer = writer.option("path", os.fspath(path)).option("checkpointLocation", os.fspath(checkpoint))
    return _trigger(writer, trigger).start()
