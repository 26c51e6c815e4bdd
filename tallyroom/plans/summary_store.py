"""Stored summaries: answer requests from the store, compute the rest, store it and pass it on to quiz rows."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import tables
from ..operators.summaries import summarize_documents
from ..schemas import OPERATIONAL
from ..session import checkpoint
from ..sinks import store

SCHEMA = OPERATIONAL["summaries"]


def read_summaries(spark: SparkSession, path) -> DataFrame:
    """The stored summaries, one row per cache key."""
    return store.read_store(spark, path, SCHEMA)


def store_summaries(path, computed: DataFrame, now: Column, buckets: int = 64) -> int:
    """Upsert computed summaries (the columns of `summarize_documents`) and return the store's version.

    A new key gets an id above all stored ones; a known key keeps id and creation time and takes the
    new text, insights and levels.
    """
    spark = computed.sparkSession
    largest = read_summaries(spark, path).agg(F.max("id")).first()[0] or 0
    rows = tables.new_summary_rows(computed, F.lit(largest + 1), now)
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
    return store.upsert(path, typed, "summary_hash", tables.merge_summaries, buckets)


def update_quiz_rows(quiz: DataFrame, before: DataFrame, updates: DataFrame) -> DataFrame:
    """Quiz rows with the text of summaries that are stored again; a key stored for the first time changes none.

    `before` are the stored summaries without the updates.
    """
    known = before.select("summary_hash").distinct()
    return tables.propagate_summaries(quiz, updates.join(known, "summary_hash", "left_semi"))


def answer_and_store(requests: DataFrame, documents: DataFrame, path, now: Column) -> DataFrame:
    """Answers to summary requests: the store's where it has one, else computed and then stored.

    The answers are cut off from the store they were read from before it changes.
    """
    spark = requests.sparkSession
    answers = checkpoint(summarize_documents(requests, documents, read_summaries(spark, path)))
    fresh = answers.where("not cached").dropDuplicates(["summary_hash"])
    if not fresh.isEmpty():
        store_summaries(path, fresh, now)
    return answers
