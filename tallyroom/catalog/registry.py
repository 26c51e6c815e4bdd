"""Registered queries: each reads the given tables whole, most with an SQL text for comparison."""

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` under a name, with its comparison SQL if there is one."""
    def add(function):
        QUERIES[name] = lambda spark, sf_dir: function(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def rounded(expression: str, places: int = 2) -> str:
    """SQL for rounding half up on ten settled decimals."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,10)), {places}) AS DOUBLE)"


def mean_sql(column: str, places: int = 2) -> str:
    return rounded(f"avg({column})", places)


class Tables:
    """The given parquet tables, and the same rows under the column names the operators expect."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))

    @cached_property
    def events(self) -> DataFrame:
        """Events with a topic (none for sign-ups) and a score up to 100 (none for errors)."""
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").withColumn("k", k).select(
            "event_id", "user_id", "ts", "event_type", "value", "props", "k",
            F.when(F.col("event_type") != "signup", F.concat(F.lit("topic"), F.floor(F.col("k") / 10)))
            .alias("topic"),
            F.when(F.col("event_type") != "error", F.least("value", F.lit(100.0))).alias("score"),
        )

    @cached_property
    def log_records(self) -> DataFrame:
        """Every event as a log record."""
        return self.events.select(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("ts").cast("string").alias("timestamp"), "topic",
            F.col("event_type").alias("action_type"), "score",
            F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).alias("quiz_id"),
            F.col("k").alias("question_count"),
            F.lit(None).cast("string").alias("question"),
            F.lit(None).cast("string").alias("response_preview"),
            F.from_json("props", "map<string,string>").alias("metadata"),
        )

    @cached_property
    def logs(self) -> dict:
        """The records split by kind into the three logs and the lake."""
        kind = F.col("action_type")
        return {
            "quiz": self.log_records.where(kind == "purchase"),
            "chat": self.log_records.where(kind == "view"),
            "activity": self.log_records.where(kind == "click"),
            "event_lake": self.log_records.where(kind.isin("error", "signup")),
        }

    @cached_property
    def quiz_results(self) -> DataFrame:
        level = (
            F.when(F.col("event_type") == "click", "easy").when(F.col("event_type") == "view", "medium")
            .when(F.col("event_type") == "purchase", "hard").when(F.col("event_type") == "signup", "expert")
        )
        return self.events.select(
            F.col("event_id").alias("id"), "user_id", F.col("k").cast("long").alias("document_id"),
            F.lit("subject").alias("subject"), F.concat(F.lit("topic"), F.floor(F.col("k") / 10)).alias("topic"),
            F.floor("value").cast("double").alias("score"), F.col("k").cast("long").alias("total_questions"),
            F.least("value", F.lit(100.0)).alias("score_percent"), level.alias("difficulty_level"),
            F.array("event_type").alias("question_types"), F.lit(None).cast("string").alias("summary_cache"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def study_sessions(self) -> DataFrame:
        return self.events.select(
            F.col("event_id").alias("id"), "user_id", F.col("k").cast("long").alias("document_id"),
            F.col("event_type").alias("subject"), "topic", F.col("k").cast("long").alias("time_spent"),
            (F.col("value") / 500).alias("engagement_score"), F.lit(1.0).alias("completion_percentage"),
            F.col("ts").cast("string").alias("created_at"),
        )

    @cached_property
    def table_events(self) -> DataFrame:
        """Every event as a row of the operational events table."""
        return self.events.select(
            F.col("event_id").alias("id"), "user_id", F.col("event_type").alias("activity_type"),
            F.col("k").cast("string").alias("resource_id"), F.col("props").alias("metadata_json"),
            F.col("k").cast("long").alias("duration_seconds"),
            F.when(F.col("event_type") != "error", F.col("value") / 500).alias("engagement_score"),
            F.when(F.col("topic").isNotNull(), F.to_json(F.array("topic", "event_type"))).alias("topics_json"),
            F.lit(None).cast("string").alias("skill_level"), F.lit(0.0).alias("completion_percentage"),
            F.lit(None).cast("string").alias("session_id"),
            F.concat(F.col("event_type"), F.lit("_event")).alias("event_type"),
            F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"score_percent": '), "k", F.lit("}")))
            .when(F.col("event_type") == "view", F.lit('{"mode": "brief"}')).otherwise(F.col("props"))
            .alias("event_data"),
            F.col("ts").cast("string").alias("created_at"),
        )

    @cached_property
    def documents(self) -> DataFrame:
        """Documents as rows of the operational documents table; the source is the topic."""
        return self.table("documents").select(
            F.col("doc_id").alias("id"), (F.col("doc_id") % 100).alias("user_id"),
            F.concat(F.lit("file_"), F.col("doc_id").cast("string"), F.lit("-notes.TXT")).alias("filename"),
            F.lit(".txt").alias("file_type"), F.col("source").alias("topic"), F.col("lang").alias("language"),
            F.col("text").alias("text_content"), F.col("n_chars").alias("usage_count"),
            F.format_string("2024-01-01T00:00:%05.2f", F.col("doc_id") % 60 * F.lit(1.0)).alias("created_at"),
        )

    @cached_property
    def doc_texts(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text")

    @cached_property
    def chat_messages(self) -> DataFrame:
        return self.table("conversations").select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("conv_id").alias("session_id"),
            (F.col("conv_id") % 10).alias("user_id"), "role", F.col("text").alias("message_text"),
            (F.length("text") % 100 / 100).alias("confidence_score"),
            F.lit('{"k": "1"}').alias("retrieval_metadata"),
            F.format_string("2024-01-01 00:%02d:00", F.col("turn")).alias("created_at"),
        )

    @cached_property
    def chat_sessions(self) -> DataFrame:
        """One session per conversation."""
        return self.table("conversations").groupBy("conv_id").agg(
            F.max("turn").alias("turns")
        ).select(
            F.col("conv_id").alias("id"), (F.col("conv_id") % 10).alias("user_id"),
            F.col("turns").alias("document_id"), F.concat(F.lit("title "), "conv_id").alias("title"),
            F.when(F.col("turns") < 4, F.concat(F.lit("topic"), "turns")).alias("topic"),
            F.lit("2024-01-01 00:00:00").alias("created_at"), F.lit("2024-01-01 00:00:00").alias("updated_at"),
        )

    @cached_property
    def search_queries(self) -> DataFrame:
        return self.table("benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


# ---- the same rows in SQL ----------------------------------------------------------

EV = """ev AS (
  SELECT event_id, user_id, ts, event_type, value, props, k,
         CASE WHEN event_type <> 'signup' THEN 'topic' || CAST(k // 10 AS VARCHAR) END AS topic,
         CASE WHEN event_type <> 'error' THEN least(value, 100.0) END AS score
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

QZ = EV + """, quiz AS (
  SELECT event_id AS id, user_id, CAST(k AS BIGINT) AS document_id,
         'topic' || CAST(k // 10 AS VARCHAR) AS topic, floor(value) AS score, CAST(k AS BIGINT) AS total_questions,
         least(value, 100.0) AS score_percent,
         CASE event_type WHEN 'click' THEN 'easy' WHEN 'view' THEN 'medium' WHEN 'purchase' THEN 'hard'
              WHEN 'signup' THEN 'expert' END AS difficulty_level,
         event_type, ts AS created_at
  FROM ev)"""

CHAT = """messages AS (
  SELECT conv_id * 1000 + turn AS id, conv_id AS session_id, conv_id % 10 AS user_id, role,
         text AS message_text, (length(text) % 100) / 100 AS confidence_score,
         '2024-01-01 00:' || lpad(CAST(turn AS VARCHAR), 2, '0') || ':00' AS created_at
  FROM conversations),
sessions AS (
  SELECT conv_id AS id, conv_id % 10 AS user_id, turns AS document_id, 'title ' || CAST(conv_id AS VARCHAR) AS title,
         CASE WHEN turns < 4 THEN 'topic' || CAST(turns AS VARCHAR) END AS topic,
         '2024-01-01 00:00:00' AS created_at, '2024-01-01 00:00:00' AS updated_at
  FROM (SELECT conv_id, max(turn) AS turns FROM conversations GROUP BY conv_id))"""
