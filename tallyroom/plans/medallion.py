"""Batch run: sources -> Bronze -> Silver -> cube -> Gold -> report."""

import json
import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators import gold, silver
from ..operators.tables import report_event
from ..sinks.zones import append_rows, write_bronze, write_zone
from ..sources.batch import load_logs, load_tables

LARGE_SCALE_FROM = 1_000_000
#: Previewed Gold tables with the order of their rows ("-": descending); a written table has no order of its own.
PREVIEWS = {
    "topic_metrics": ["-difficulty_score", "-attempts", "-events", "topic"],
    "user_engagement": ["-total_events", "-avg_score", "user_id"],
    "daily_activity": ["event_date"],
    "student_clusters": ["user_id", "topic"],
    "performance_predictions": ["user_id", "topic"],
    "learning_recommendations": ["-difficulty_score", "-attempts", "topic"],
}
PREVIEW_ROWS = 15
ARCHITECTURE = {
    "flow": "event logs, lake and tables -> Bronze -> Silver -> activity cube -> Gold -> report",
    "formats": {"raw": "json", "bronze": "parquet", "silver": "parquet", "gold": "parquet"},
}
REPORT_NAME = "end_to_end_batch"


@dataclass(frozen=True)
class Locations:
    """Folders of a deployment, on storage all executors share."""

    root: str

    def at(self, *parts) -> str:
        return os.path.join(self.root, *parts)

    @property
    def logs(self):
        return self.at("logs")

    @property
    def lake(self):
        return self.at("lakehouse", "raw_events")

    @property
    def tables(self):
        return self.at("tables")

    @property
    def bronze(self):
        return self.at("bronze")

    @property
    def silver(self):
        return self.at("silver")

    @property
    def gold(self):
        return self.at("gold")

    @property
    def reports(self):
        return self.at("reports", REPORT_NAME)


def _counted(frames: dict) -> tuple:
    """Frames that count their rows while they are written, and the observers to ask afterwards."""
    watched, observers = {}, {}
    for name, frame in frames.items():
        observer = Observation(f"rows_{name}")
        watched[name] = frame.observe(observer, F.count(F.lit(1)).alias("rows"))
        observers[name] = observer
    return watched, observers


def _total(observers: dict) -> int:
    return sum(observer.get["rows"] for observer in observers.values())


def _read_back(spark: SparkSession, written: dict, schemas: dict) -> dict:
    return {name: spark.read.schema(schemas[name]).parquet(path) for name, path in written.items()}


def _first_rows(frame: DataFrame, order: list) -> list:
    columns = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    return frame.orderBy(*columns).limit(PREVIEW_ROWS).collect()


def report_row(spark: SparkSession, report: dict) -> DataFrame:
    """The report as a one-row frame: scalar columns, nested parts as JSON text."""
    flat = {
        k: (json.dumps(v, default=str) if isinstance(v, (dict, list)) else v) for k, v in report.items()
    }
    return spark.createDataFrame([flat])


def write_report(spark: SparkSession, report: dict, path) -> None:
    body = json.dumps(report, default=str)
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("overwrite").text(os.fspath(path))


def scale_class(events: int) -> str:
    return "large_scale" if events >= LARGE_SCALE_FROM else "medium_scale"


def run(spark: SparkSession, root, table_format: str = "parquet", use_metadata: bool = False,
        event_table=None) -> dict:
    """Run the whole flow under `root` and return the report, which is also written there.

    With `event_table` the report is also appended to that table, as a row of events.

    Each zone is written once and read back, so no later step recomputes an
    earlier one, and a lost executor costs at most the work since the last zone.
    Row counts are observed during the writes instead of counted again.
    """
    where = Locations(os.fspath(root))
    started = time.perf_counter()
    try:
        report = _run(spark, where, table_format, use_metadata, started)
    except Exception as error:
        failed = {
            "report_name": REPORT_NAME, "status": "failed", "records_processed": 0,
            "processing_seconds": round(time.perf_counter() - started, 2), "error": str(error),
            "architecture": ARCHITECTURE,
        }
        write_report(spark, failed, where.reports)
        raise
    write_report(spark, report, where.reports)
    if event_table is not None:
        append_rows(report_event(report_row(spark, report)), event_table)
    return report


def _run(spark, where, table_format, use_metadata, started) -> dict:
    logs, log_counts = _counted(load_logs(spark, where.logs, where.lake))
    tables, table_counts = _counted(load_tables(spark, where.tables, table_format))
    bronze_paths = write_bronze(logs, tables, where.bronze)
    bronze_logs = _read_back(
        spark, {n: bronze_paths[f"log_{n}"] for n in logs}, {n: f.schema for n, f in logs.items()}
    )
    bronze_tables = _read_back(
        spark, {n: bronze_paths[f"table_{n}"] for n in tables}, {n: f.schema for n, f in tables.items()}
    )

    events, event_counts = _counted(
        {"events": silver.silver_events(bronze_logs, bronze_tables, use_metadata)}
    )
    frames = {**events, "documents": silver.silver_documents(bronze_tables["documents"])}
    silver_paths = write_zone(frames, where.silver)
    clean = _read_back(spark, silver_paths, {n: f.schema for n, f in frames.items()})

    timed = clean["events"].where(F.col("event_timestamp").isNotNull())
    cube = gold.activity_cube(timed)
    cube_path = write_zone({"activity_cube": cube}, where.silver)
    cube = _read_back(spark, cube_path, {"activity_cube": cube.schema})["activity_cube"]
    # The models fit on the features as written, not on another roll-up of the cube.
    features = gold.recommendation_features(cube)
    feature_path = write_zone({"recommendation_features": features}, where.gold)
    features = _read_back(spark, feature_path, {"recommendation_features": features.schema})["recommendation_features"]
    gold_tables = gold.gold_tables(cube, clean["documents"], features)
    del gold_tables["recommendation_features"]
    gold_paths = feature_path | write_zone(gold_tables, where.gold)

    processed = _total(event_counts)
    seconds = round(time.perf_counter() - started, 2)
    stored = {n: spark.read.parquet(gold_paths[n]) for n in PREVIEWS}
    return {
        "report_name": REPORT_NAME,
        "status": "completed",
        "architecture": ARCHITECTURE,
        "source_paths": {"logs": where.logs, "tables": where.tables, "raw_event_lake": where.lake},
        "bronze_paths": bronze_paths,
        "silver_paths": silver_paths,
        "gold_paths": gold_paths,
        "records_processed": processed,
        "log_records_ingested": _total(log_counts),
        "database_records_ingested": _total(table_counts),
        "processing_seconds": seconds,
        "records_per_second": round(processed / seconds, 2) if seconds > 0 else 0.0,
        "scale_classification": scale_class(processed),
        **{
            f"{n}_preview": [row.asDict() for row in _first_rows(frame, PREVIEWS[n])]
            for n, frame in stored.items()
        },
    }
