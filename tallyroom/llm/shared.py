"""What several operators share: tables, the shared folder, folds, worker caches, components."""

import os
import sys
import types
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Executors need not have this package: what runs in their Python workers travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space between words in every contract of this folder.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`, which all executors see.

    Only a session without that setting (a test) gets a folder next to its warehouse.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or os.path.join(
        spark.conf.get("spark.sql.warehouse.dir"), "shared")
    return f"{base}/{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written as Parquet into the shared folder and read back: a cut that outlives executors."""
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def fold(doc_id: str, count: int) -> Column:
    """crc32 of the id as text, modulo `count`; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % count


def kept(name: str, build: Callable):
    """An object that a Python worker builds once and keeps over its tasks."""
    shelf = sys.modules.setdefault("_tallyroom_kept", types.ModuleType("_tallyroom_kept"))
    if not hasattr(shelf, name):
        setattr(shelf, name, build())
    return getattr(shelf, name)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every linked node: `root` is the smallest node of its component.

    `links` has two long columns and should hold a forest or little more. Each round
    ties larger neighbours to the smallest one of a node, then all neighbours to the
    smallest of the smaller side; it ends when a round changes nothing. Rounds grow
    with the logarithm of the component size, each is written to the shared folder,
    and the sums that are compared are the only values the driver sees. A node with
    very many links is aggregated on the map side first; its links then go to their
    other ends.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        small = joined.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                              F.col("m").alias("v")).where("u <> v").distinct()
        edges = stored(small)
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

