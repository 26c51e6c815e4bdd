"""Session settings and lineage cuts."""

import os

from pyspark.sql import DataFrame, SparkSession

# Settings that fit a cluster as well as a test; sizes stay with the caller.
BASE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.mergeSchema": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name="tallyroom", master=None, settings=None) -> SparkSession:
    """A session with BASE_SETTINGS; `master` and sizes are left to spark-submit if not given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint(frame: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Cut the lineage into the shared checkpoint folder named by the session.

    The folder comes from `spark.checkpoint.dir`. `fallback_dir` is only for
    sessions without that setting, such as tests; a machine-local folder would
    not survive the loss of an executor.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = context.getConf().get("spark.checkpoint.dir", None) or fallback_dir
        if shared is None:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(os.fspath(shared))
    return frame.checkpoint(eager=True)


def kept(frame: DataFrame) -> DataFrame:
    """The frame behind a lineage cut, so that what uses it several times computes it once.

    A session that names no shared folder computes it at each use, with the same rows.
    """
    context = frame.sparkSession.sparkContext
    named = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir", None)
    return checkpoint(frame) if named else frame


def tasks(frame: DataFrame) -> int:
    """Partitions for rows that are few but dear: coalesced by their bytes they would be one task."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
