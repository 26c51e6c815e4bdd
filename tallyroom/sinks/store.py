"""A keyed table in a folder that takes upserts: copy-on-write by key bucket, numbered versions.

    <path>/data/v<k>/bucket=<b>/...   rows of the buckets that version k rewrote
    <path>/manifest/v<k>/...          for each bucket the version whose rows count

A merge reads and rewrites only the buckets its keys fall into. The manifest is written last,
so readers see the old rows or the new ones and never a mixture, a merge that failed half way
changes nothing, and of two writers with one version number the second fails.
"""

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path) -> list[int]:
    """Finished versions, oldest first."""
    pattern, files = _folder(spark, f"{os.fspath(path)}/manifest/v*/_SUCCESS")
    found = files.globStatus(pattern) or []
    return sorted(int(f.getPath().getParent().getName()[1:]) for f in found)


def _manifest(spark: SparkSession, path: str, version: int) -> dict[int, int]:
    """Version of each bucket that holds rows: as many numbers as there are buckets."""
    rows = spark.read.schema("bucket int, version int").parquet(f"{path}/manifest/v{version}").collect()
    return {r["bucket"]: r["version"] for r in rows}


def read_store(spark: SparkSession, path, schema, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
    """The rows of the newest version, or of an older one; `buckets` limits the read to some. Empty without a version."""
    path = os.fspath(path)
    known = versions(spark, path)
    chosen = version if version is not None else (known[-1] if known else None)
    if version is not None and version not in known:
        raise FileNotFoundError(f"no version {version} in {path}")
    places = _manifest(spark, path, chosen) if chosen is not None else {}
    folders = [f"{path}/data/v{v}/bucket={b}" for b, v in sorted(places.items())
               if b >= 0 and (buckets is None or b in buckets)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def upsert(path, updates: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64) -> int:
    """Merge `updates` into the store and return the new version.

    `merge(stored, updates)` gets the rows of the touched buckets and all updates, and returns the rows
    that replace them, in the columns and types of `stored`; it must keep the rows it does not change.
    `key` is the column that names a row, and NULL is a key too. `buckets` is fixed by the first merge.
    Updates are read twice: pass a written table if they are expensive.
    """
    spark, path = updates.sparkSession, os.fspath(path)
    known = versions(spark, path)
    places = _manifest(spark, path, known[-1]) if known else {}
    count = places.pop(-1, buckets)  # the manifest's row -1 holds the number of buckets
    bucket = F.pmod(F.xxhash64(key), F.lit(count)).cast("int")
    touched = sorted(r[0] for r in updates.select(bucket).distinct().collect())  # at most `count` numbers
    version = known[-1] + 1 if known else 0
    folders = [f"{path}/data/v{places[b]}/bucket={b}" for b in touched if b in places]
    stored = (spark.read.schema(updates.schema).parquet(*folders) if folders
              else spark.createDataFrame([], updates.schema))
    data = f"{path}/data/v{version}"
    merge(stored, updates).withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy(
        "bucket").parquet(data)
    pattern, files = _folder(spark, f"{data}/bucket=*")
    written = {int(f.getPath().getName().split("=")[1]) for f in files.globStatus(pattern) or []}
    places = {b: v for b, v in places.items() if b not in touched} | dict.fromkeys(written, version)
    rows = [(-1, count), *places.items()]
    spark.createDataFrame(rows, "bucket int, version int").coalesce(1).write.mode("error").parquet(f"{path}/manifest/v{version}")
    return version


def drop_old_versions(spark: SparkSession, path, keep: int = 2) -> None:
    """Remove the manifests before the last `keep` and the data that no kept one names."""
    path = os.fspath(path)
    known = versions(spark, path)
    kept, gone = known[-keep:], known[:-keep]
    used = {v for k in kept for b, v in _manifest(spark, path, k).items() if b >= 0}
    for version in gone:
        folder, files = _folder(spark, f"{path}/manifest/v{version}")
        files.delete(folder, True)
    for version in gone:
        if version not in used:
            folder, files = _folder(spark, f"{path}/data/v{version}")
            files.delete(folder, True)
