"""Window-like helpers whose work does not pile up on a hot key.

A plain window over a key sends all rows of that key to one task. The helpers
here either prune on the map side (`newest`, `ranked`), or split a key into
time buckets, so that only small per-bucket totals meet in one place.
"""

from pyspark.sql import DataFrame, Window, functions as F


def ranked(frame: DataFrame, keys: list, order: list, limit: int, name: str = "rank") -> DataFrame:
    """First `limit` rows of each key with their rank.

    Spark plans `row_number() <= n` with a group limit in front of the shuffle,
    so each map task passes on at most `limit` rows of a key.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn(name, F.row_number().over(window)).where(F.col(name) <= limit)


def positions(
    frame: DataFrame, keys: list, ts: str, tie: list, bucket: str = "hour",
    position: str = "position", size: str = "group_size",
) -> DataFrame:
    """Exact 1-based position of every row within its key by (ts, tie), and the key's row count.

    Rows are numbered inside (key, time bucket) and shifted by the count of all
    earlier buckets, so the largest task holds one bucket rather than one key.
    Pick a finer `bucket` when a single one is still too large. Rows without a
    timestamp come last.
    """
    part = "__bucket"
    cut = frame.withColumn(part, F.date_trunc(bucket, F.col(ts)))
    per_key = Window.partitionBy(*keys)
    earlier = per_key.orderBy(F.asc_nulls_last(part)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        cut.groupBy(*keys, part)
        .agg(F.count("*").alias("__rows"))
        .select(
            *keys, part,
            F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
            F.sum("__rows").over(per_key).alias(size),
        )
    )
    inside = Window.partitionBy(*keys, part).orderBy(F.asc_nulls_last(ts), *tie)
    numbered = cut.withColumn("__inside", F.row_number().over(inside))
    left, right = numbered.alias("l"), offsets.alias("r")
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, part]]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    return left.join(right, on).select(
        "l.*", F.col(f"r.{size}").alias(size), (F.col("r.__before") + F.col("l.__inside")).alias(position)
    ).drop(part, "__inside")


def keep_or_fall_back(frame: DataFrame, keys: list, preferred) -> DataFrame:
    """Rows that meet `preferred`; for keys without such a row, all of their rows.

    The keys with a hit are found by a map-side-combined aggregate, and the other
    keys come from an anti join, whose skewed side adaptive execution can split.
    Rows with a NULL key belong to no group and are kept.
    """
    hit = F.coalesce(preferred, F.lit(False))
    served = frame.where(hit).select(*keys).distinct()
    return frame.where(hit).unionByName(frame.where(~hit).join(served, keys, "left_anti"))
