"""Dataset profiling, anomalies and time series over any DataFrame."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbers import round_half_up

#: Equal steps into which one round of a rank selection cuts a range, and rounds: a range ends up 2 to the 30th part
#: of its column's.
STEPS = 1024
ROUNDS = 3
_AGGREGATIONS = {"sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count}


def numeric_columns(frame: DataFrame) -> list:
    return [f.name for f in frame.schema if isinstance(f.dataType, T.NumericType)]


def _need(frame: DataFrame, column: str) -> None:
    if column not in frame.columns:
        raise ValueError(f"column not found: {column}")


def _missing(frame: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating-point column."""
    null = F.col(name).isNull()
    floating = isinstance(frame.schema[name].dataType, (T.DoubleType, T.FloatType))
    return null | F.isnan(name) if floating else null


def profile(frame: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells, duplicate rows, numeric and other columns.

    Duplicates are counted by grouping equal rows, which combines on the map
    side, so many copies of one row shrink before the shuffle. All figures come
    out of that one pass.
    """
    numeric = numeric_columns(frame)
    other = [c for c in frame.columns if c not in numeric]
    gaps = reduce(lambda a, b: a + b, [_missing(frame, c).cast("long") for c in frame.columns])
    distinct = frame.groupBy(*frame.columns).agg(F.count("*").alias("__copies"))
    return distinct.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows"),
        F.lit(len(frame.columns)).alias("columns"),
        F.coalesce(F.sum(gaps * F.col("__copies")), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_rows"),
        F.lit(",".join(numeric)).alias("numeric_columns"),
        F.lit(",".join(other)).alias("other_columns"),
        F.lit(",".join(f"{n}:{t}" for n, t in frame.dtypes)).alias("column_types"),
    )


def _present(frame: DataFrame, name: str) -> Column:
    return F.when(~_missing(frame, name), F.col(name).cast("double"))


def _value_counts(frame: DataFrame, names: list) -> DataFrame:
    """How often each value stands in each column: i (the column's place in `names`), value, n.

    Missing values are counted as column i + len(names) with value 0. So no column here is ever NULL,
    and no filter for NULLs reaches one use of the counts but not the others: all uses share one scan
    and one shuffle, in front of which equal values have been added up.
    """
    return _cells(frame, names).groupBy("i", "value").agg(F.count("*").alias("n"))


def _cells(frame: DataFrame, names: list) -> DataFrame:
    count = len(names)
    cells = F.array(*[
        F.struct(F.when(_present(frame, n).isNull(), i + count).otherwise(i).alias("i"),
                 F.coalesce(_present(frame, n), F.lit(0.0)).alias("value")) for i, n in enumerate(names)])
    return frame.select(F.explode(cells).alias("c")).select("c.*")


def _column_name(names: list) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("column")


def numeric_summary(frame: DataFrame, exact_quantiles: bool = True, accuracy: int = 10000) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, min, quartiles, max, median, missing.

    All figures come from the columns' value counts, so the data is scanned once however many
    columns there are. Exact quartiles interpolate linearly between neighbours (`_quantiles`);
    `exact_quantiles=False` takes them from a sketch, for which the data is scanned again.
    """
    names = numeric_columns(frame)
    if not names:
        raise ValueError("no numeric columns")
    cuts = [0.25, 0.5, 0.75]
    counts = _value_counts(frame, names)
    n, value, there = F.col("n"), F.col("value"), F.col("i") < len(names)
    own = (F.col("i") % len(names)).alias("i")
    sums = counts.groupBy(own).agg(
        F.coalesce(F.sum(F.when(there, n)), F.lit(0)).alias("count"),
        (F.sum(F.when(there, value * n)) / F.sum(F.when(there, n))).alias("mean"),
        F.min(F.when(there, value)).alias("min"), F.max(F.when(there, value)).alias("max"),
        F.coalesce(F.sum(F.when(~there, n)), F.lit(0)).alias("missing"))
    # The mean is known before squares are added up: no digits are lost to large values close together.
    means = counts.groupBy("i").agg((F.sum(value * n) / F.sum(n)).alias("mean"))
    spread = counts.join(means, "i").groupBy("i").agg(
        F.sum(n * (value - F.col("mean")) ** 2).alias("squares"))
    rows = sums.join(spread, "i", "left")
    if exact_quantiles:
        quantiles = _quantiles(counts, cuts)
    else:
        quantiles = _cells(frame, names).groupBy("i").agg(F.percentile_approx("value", cuts, accuracy).alias("q"))
    rows = rows.join(quantiles, "i", "left")
    return rows.select(
        _column_name(names), "count", "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("squares") / (F.col("count") - 1))).alias("std"), "min",
        F.get("q", F.lit(0)).alias("q25"), F.get("q", F.lit(1)).alias("q50"), F.get("q", F.lit(2)).alias("q75"),
        "max", F.get("q", F.lit(1)).alias("median"), "missing",
    )


def exact_quantile_arrays(frame: DataFrame, names: list, cuts: list, ranges: int = STEPS) -> DataFrame:
    """Exact, linearly interpolated quantiles per column: column, q (array in the order of `cuts`).

    NULL and NaN do not count; a column without values has no row.
    """
    return _quantiles(_value_counts(frame, names), cuts, ranges).where(F.col("i") < len(names)).select(_column_name(names), "q")


def _quantiles(counts: DataFrame, cuts: list, ranges: int = STEPS) -> DataFrame:
    """Quantiles of counted values (i, value, n), none of them NULL: i, q.

    Selection by repeated narrowing: each round cuts the ranges that a wanted rank lies in into
    equal steps and counts the steps on the map side, so only small counts meet. After the last
    round the few values of the wanted ranges are put in order. Nothing runs while the frame is
    built, and no sketch is drawn.
    """
    per_column = counts.groupBy("i").agg(F.sum("n").alias("total"), F.min("value").alias("low"), F.max("value").alias("high"))
    places = F.flatten(F.array(*[F.array(F.floor((F.col("total") - 1) * c).cast("long"), F.ceil((F.col("total") - 1) * c).cast("long"))
                                 for c in cuts]))
    # Wanted: the ranks (from 0) that lie in a range, and how many values stand before it.
    wanted = per_column.select("i", "low", "high", F.lit(0).cast("long").alias("before"), F.array_distinct(places).alias("ranks"))
    for _ in range(ROUNDS):
        # At most two ranges for each cut of a column: bounded by the columns, not by the data.
        inside = counts.join(F.broadcast(wanted), "i").where("value >= low and value <= high")
        width = F.col("high") - F.col("low")
        step = F.when((width > 0) & (width < float("inf")), F.least(F.floor((F.col("value") - F.col("low")) / width * ranges), F.lit(ranges - 1)))
        # A range that infinity ends has two halves: what is infinite, and what is not.
        step = F.coalesce(step, F.when(F.col("value") == float("-inf"), -1).when(F.col("value") == float("inf"), ranges).otherwise(0)).cast("int")
        steps = inside.groupBy("i", "before", "ranks", step.alias("step")).agg(
            F.sum("n").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
        earlier = Window.partitionBy("i", "before").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        wanted = steps.withColumn("before", F.col("before") + F.coalesce(F.sum("rows").over(earlier), F.lit(0))).select(
            "i", "low", "high", "before",
            F.filter("ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("rows"))).alias("ranks"),
        ).where(F.size("ranks") > 0)
    running = Window.partitionBy("i", "before").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ordered = counts.join(F.broadcast(wanted), "i").where("value >= low and value <= high").withColumn(
        "upto", F.col("before") + F.sum("n").over(running))
    hits = ordered.select("i", "value", F.explode(F.filter(
        "ranks", lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))).alias("rank"))
    by_rank = hits.groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def quantile(c):
        spot = (F.col("total") - 1) * c
        low, high = (F.element_at("at", f(spot).cast("long")) for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (high - low) * (spot - F.floor(spot)))

    return by_rank.join(per_column, "i").select("i", F.array(*map(quantile, cuts)).alias("q"))


def top_categories(frame: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """Most frequent values as text, NULL as `Missing`."""
    label = F.coalesce(F.col(column).cast("string"), F.lit("Missing"))
    return (
        frame.groupBy(label.alias(column))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
        .limit(limit)
    )


def aggregate_metrics(frame: DataFrame, group: str, metric: str, how: str) -> DataFrame:
    """One aggregate per group (NULL included), largest first."""
    _need(frame, group)
    if how not in _AGGREGATIONS:
        raise ValueError(f"unsupported aggregation: {how}")
    _need(frame, metric)
    return (
        frame.groupBy(group).agg(_AGGREGATIONS[how](metric).alias(metric)).orderBy(F.desc(metric), group)
    )


def correlation_matrix(frame: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, over rows where both are present.

    Each row gives one short row per pair, and one aggregate with a single correlation adds them
    up before the shuffle: the data is scanned once, and the code stays compiled however many
    columns there are. The result has one row per pair in both directions, the diagonal included.
    """
    names = numeric_columns(frame)
    if len(names) < 2:
        raise ValueError("a correlation needs two numeric columns")
    values = [_present(frame, n).alias(f"v{i}") for i, n in enumerate(names)]
    pairs = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"v{i}").alias("x"), F.col(f"v{j}").alias("y"))
        for i in range(len(names)) for j in range(i, len(names))
    ])
    upper = frame.select(*values).select(F.explode(pairs).alias("p")).groupBy("p.i", "p.j").agg(F.corr("p.x", "p.y").alias("r"))
    known = F.array(*map(F.lit, names))
    a, b = (F.element_at(known, F.col(c) + 1) for c in ("i", "j"))
    both = F.when(a == b, F.array(F.struct(a.alias("a"), b.alias("b")))).otherwise(
        F.array(F.struct(a.alias("a"), b.alias("b")), F.struct(b.alias("a"), a.alias("b"))))
    return upper.select(F.explode(both).alias("p"), "r").select(
        F.col("p.a").alias("column_a"), F.col("p.b").alias("column_b"), F.col("r").alias("correlation")
    )


def detect_anomalies(frame: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows at least `threshold` sample deviations from the mean, most extreme first.

    What is not a number is left out; without any spread nothing is an anomaly.
    The mean and deviation reach the filter as scalar subqueries: one aggregate
    pass, no join.
    """
    _need(frame, column)
    if threshold <= 0:
        raise ValueError("threshold must be greater than 0")
    numeric = frame.withColumn("__value", F.col(column).try_cast("double")).where(
        F.col("__value").isNotNull() & ~F.isnan("__value")
    )
    stats = numeric.agg(
        F.struct(F.avg("__value").alias("mean"), F.stddev_samp("__value").alias("std")).alias("s")
    )
    scored = numeric.withColumn("__stats", stats.scalar())
    z = F.try_divide(F.col("__value") - F.col("__stats.mean"), F.nullif(F.col("__stats.std"), F.lit(0.0)))
    return (
        scored.withColumn("__z", z)
        .where(F.abs("__z") >= threshold)
        .withColumn("anomaly_score", round_half_up(F.col("__z"), 2))
        .drop("__value", "__stats", "__z")
        .orderBy(F.desc(F.abs("anomaly_score")))
    )


def infer_time_column(frame: DataFrame) -> str | None:
    """First text, date or time column that parses as a time in max(3, a third of the rows) rows."""
    kinds = (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    candidates = [f.name for f in frame.schema if isinstance(f.dataType, kinds)]
    if not candidates:
        return None
    counts = [
        F.count(F.try_to_timestamp(F.col(c).cast("string"))).alias(f"c{i}")
        for i, c in enumerate(candidates)
    ]
    found = frame.agg(F.count("*").alias("rows"), *counts).first()
    needed = max(3, found["rows"] // 3)
    return next((c for i, c in enumerate(candidates) if found[f"c{i}"] >= needed), None)


def infer_time_series(frame: DataFrame) -> tuple:
    """The time column's name and the frame with it parsed; (None, frame) without one."""
    name = infer_time_column(frame)
    if name is None:
        return None, frame
    return name, frame.withColumn(name, F.try_to_timestamp(F.col(name).cast("string")))


def build_time_series(frame: DataFrame, date_column: str, metric: str) -> DataFrame:
    """Monthly sums of a metric, labelled `yyyy-MM`."""
    _need(frame, date_column)
    _need(frame, metric)
    parsed = F.try_to_timestamp(F.col(date_column).cast("string"))
    return (
        frame.select(parsed.alias("__ts"), metric)
        .where(F.col("__ts").isNotNull())
        .groupBy(F.date_format("__ts", "yyyy-MM").alias(date_column))
        .agg(F.sum(metric).alias(metric))
        .orderBy(date_column)
    )
