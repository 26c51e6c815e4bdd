"""Sinks: Bronze/Silver/Gold zones, the raw lake, log fan-out, exports, run reports."""

import datetime
import os

from pyspark.sql import Column, DataFrame, Observation, functions as F

from .. import schemas
from ..functions.clocks import parse_ts


def write_zone(frames: dict, root, partition_by: dict | None = None) -> dict:
    """Overwrite one parquet table per frame below `root`; returns name -> path.

    A partitioned table is replaced whole: partitions without new rows go as well.
    """
    written = {}
    for name, frame in frames.items():
        target = os.path.join(root, name)
        writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "static")
        keys = (partition_by or {}).get(name)
        if keys:
            writer = writer.partitionBy(*keys)
        writer.parquet(target)
        written[name] = target
    return written


def write_bronze(logs: dict, tables: dict, root) -> dict:
    """Logs and operational tables as parquet; returned names carry their kind."""
    log_paths = write_zone(logs, os.path.join(root, "logs"))
    table_paths = write_zone(tables, os.path.join(root, "app_db"))
    return {
        **{f"log_{name}": path for name, path in log_paths.items()},
        **{f"table_{name}": path for name, path in table_paths.items()},
    }


def now_text() -> str:
    """The present moment as records write it, fixed once for all writes of a batch."""
    return datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds")


def stamped(records: DataFrame, now: str | None = None) -> DataFrame:
    """Records in which a missing or empty timestamp is taken as now."""
    stamp = F.coalesce(F.nullif(F.col("timestamp"), F.lit("")), F.lit(now or now_text()))
    return records.withColumn("timestamp", stamp)


def local_day(stamp: Column) -> Column:
    """The calendar day written in a timestamp's own text (its offset cut off), NULL if unreadable."""
    local = F.regexp_replace(stamp, r"^([^ T]+[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?).*$", "$1")
    return F.when(parse_ts(stamp).isNotNull(), F.to_date(parse_ts(local)))


def lake_rows(records: DataFrame, event_type) -> DataFrame:
    """Records with the lake's folder columns, which are NULL where the timestamp can't be read.

    The folder is the calendar day of the record's own text, so an offset in the
    timestamp does not move it to another day. A missing timestamp is taken as now.
    """
    kind = event_type if not isinstance(event_type, str) else F.lit(event_type)
    day = local_day(F.col("timestamp"))
    return stamped(records).withColumns({
        "event_type": kind, "year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    })


def append_to_lake(records: DataFrame, event_type, root, rejects=None) -> int:
    """Append JSON files under event_type=/year=/month=/day=; part files never collide.

    Records with an unreadable timestamp go, with the reason, to the folder `rejects`
    (by default next to the lake); returns how many there were.
    """
    rows = lake_rows(records, event_type)
    rows.where(F.col("year").isNotNull()).write.mode("append").partitionBy("event_type", "year", "month", "day").json(
        os.fspath(root))
    refused = rows.where(F.col("year").isNull()).drop("year", "month", "day").withColumn(
        "reason", F.lit("unreadable timestamp"))
    seen = Observation("rejected")
    refused.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").json(
        os.fspath(rejects) if rejects else f"{os.fspath(root).rstrip('/')}_rejects")
    return seen.get["rows"]


def event_type_of_log(file_name) -> "F.Column":
    """Lake event type of a log file: `quiz`, `chat`, `activity`."""
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    stem = F.regexp_replace(F.regexp_replace(name, r"\.json", ""), "_logs", "")
    return F.regexp_replace(stem, "user_activity", "activity")


def publish_events(records: DataFrame, log_name: str, logs_dir, micro_batch_dir, lake_dir,
                   kafka_options: dict | None = None) -> None:
    """Send one batch of records to the log, the micro-batch folder, the lake and, if set, Kafka.

    The records are persisted for the duration, so the upstream plan runs once. A missing
    time is filled in before the writes, so all copies of a record agree.
    """
    layout = [c for c in schemas.LOG_LAYOUTS[log_name] if c in records.columns]
    file_name = schemas.LOG_FILES[log_name]
    batch = stamped(records.select(*layout)).persist()
    try:
        batch.write.mode("append").json(os.path.join(logs_dir, file_name))
        batch.write.mode("append").json(os.fspath(micro_batch_dir))
        append_to_lake(batch, event_type_of_log(file_name), lake_dir)
        if kafka_options:
            batch.select(F.to_json(F.struct(*layout)).alias("value")).write.format("kafka").options(
                **kafka_options
            ).save()
    finally:
        batch.unpersist()


def history_records(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Table events as log records for a backfill of the lake: all, or the newest `limit`."""
    topics = F.from_json("topics_json", "array<string>")
    newest = events if limit is None else events.orderBy(F.desc("id")).limit(limit)
    return newest.select(
        F.coalesce(F.col("user_id").cast("string"), F.lit("")).alias("user_id"),
        F.col("created_at").alias("timestamp"),
        F.when(F.coalesce("topics_json", F.lit("")) != "", F.get(topics, F.lit(0)))
        .otherwise(F.lit("general")).alias("topic"),
        F.col("activity_type").alias("action_type"),
        F.lit(None).cast("double").alias("score"),
        F.coalesce(
            F.from_json("event_data", "map<string,string>"), F.create_map().cast("map<string,string>")
        ).alias("metadata"),
    )


def backfill_lake(events: DataFrame, root, limit: int | None = None) -> int:
    """Backfill the lake; returns how many records went to the rejects."""
    return append_to_lake(history_records(events, limit), "historical_activity", root)


def export_rows(tables: dict, name: str, user_id=None) -> DataFrame:
    """An operational table for export; with `user_id` only that user's rows where it has owners."""
    if name not in schemas.OPERATIONAL:
        raise ValueError(f"unsupported export table: {name}")
    frame = tables[name]
    if user_id is not None and "user_id" in frame.columns:
        frame = frame.where(F.col("user_id") == F.lit(user_id))
    return frame


def export_table(tables: dict, name: str, path, file_format="csv", user_id=None) -> None:
    writer = export_rows(tables, name, user_id).write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(os.fspath(path))
    elif file_format == "json":
        writer.json(os.fspath(path))
    else:
        raise ValueError("export as csv or json")


def append_rows(frame: DataFrame, path) -> None:
    """Append rows to an operational parquet table."""
    frame.write.mode("append").parquet(os.fspath(path))
