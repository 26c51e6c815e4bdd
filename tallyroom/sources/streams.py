"""Streaming sources that deliver LOG_RECORD rows."""

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas

# Fixed value: how many files one micro-batch takes.
FILES_PER_TRIGGER = 25


def file_stream(spark: SparkSession, folder, files_per_trigger=FILES_PER_TRIGGER) -> DataFrame:
    return (
        spark.readStream.schema(schemas.LOG_RECORD)
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(os.fspath(folder))
    )


def kafka_options(servers: str, topics: list, starting="latest") -> dict:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }


def decode_payload(raw: DataFrame) -> DataFrame:
    """Message bytes to LOG_RECORD columns; what is not JSON becomes a row of NULLs."""
    record = F.from_json(F.col("value").cast("string"), schemas.LOG_RECORD)
    return raw.select(record.alias("record")).select("record.*")


def kafka_stream(spark: SparkSession, servers: str, topics: list, starting="latest") -> DataFrame:
    """Records from several topics; needs Spark's Kafka package on the class path."""
    raw = spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting)).load()
    return decode_payload(raw)


def event_stream(spark: SparkSession, folder=None, servers=None, topics=None) -> DataFrame:
    """Kafka when servers are given, else the micro-batch folder."""
    if servers:
        return kafka_stream(spark, servers, topics)
    return file_stream(spark, folder)
