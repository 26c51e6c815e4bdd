"""Gold tables.

Each event becomes a row of measures (`measured_events`), and every table is a
roll-up of measures. A roll-up of roll-ups gives the same totals, so a run that
needs all tables first builds one cube by user, topic, hour and event type,
stores it, and reads the tables off the cube; the events are then shuffled once,
after map-side combining. Counting the users of a topic needs no distinct: after
grouping by (topic, user) each user is one row, and a hot topic or user is
spread over its other keys.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.clocks import time_of
from ..functions.numbers import band, difficulty, formula_prediction, mean
from ..functions.clocks import hour_label

CUBE_KEYS = ["user_id", "topic", "event_hour", "event_type"]
_MEASURES = [
    "events", "scored", "score_total", "score_best", "duration_seconds", "engagement_total",
    "engagement_rows",
]


def measured_events(events: DataFrame, time_column: str = "event_timestamp") -> DataFrame:
    """Cube keys and measures of single events; columns that are not there count as NULL."""
    def have(name, kind):
        return F.col(name).cast(kind) if name in events.columns else F.lit(None).cast(kind)

    ts = time_of(events, time_column) if time_column in events.columns else F.lit(None).cast("timestamp")
    score, engagement = have("score", "double"), have("engagement_score", "double")
    return events.select(
        have("user_id", "string").alias("user_id"),
        have("topic", "string").alias("topic"),
        F.date_trunc("hour", ts).alias("event_hour"),
        have("event_type", "string").alias("event_type"),
        F.lit(1).cast("long").alias("events"),
        score.isNotNull().cast("long").alias("scored"),
        score.alias("score_total"),
        score.alias("score_best"),
        have("duration_seconds", "long").alias("duration_seconds"),
        engagement.alias("engagement_total"),
        engagement.isNotNull().cast("long").alias("engagement_rows"),
    )


def roll_up(measures: DataFrame, *keys) -> DataFrame:
    """Aggregate measures (of events or of a finer roll-up) onto the given keys."""
    totals = [
        (F.max(m) if m == "score_best" else F.sum(m)).alias(m) for m in _MEASURES
    ]
    return measures.groupBy(*keys).agg(*totals)


def activity_cube(events: DataFrame, time_column: str = "event_timestamp") -> DataFrame:
    """Measures per user, topic, hour and event type, the common base of all tables."""
    return roll_up(measured_events(events, time_column), *CUBE_KEYS)


def _topic_totals(measures: DataFrame) -> DataFrame:
    named = measures.where(F.col("topic").isNotNull()).withColumn("topic", F.trim("topic"))
    per_user = roll_up(named, "topic", "user_id")
    return per_user.groupBy("topic").agg(
        F.sum("score_total").alias("score_total"),
        F.sum("scored").alias("attempts"),
        F.sum("events").alias("events"),
        F.count("user_id").alias("unique_users"),
    )


def topic_metrics(measures: DataFrame) -> DataFrame:
    """Average, attempts, traffic, users and difficulty per topic, hardest first."""
    return (
        _topic_totals(measures)
        .withColumn("avg_score", mean(F.col("score_total"), F.col("attempts")))
        .withColumn("difficulty_score", difficulty(F.col("avg_score"), F.col("events")))
        .select("topic", "avg_score", "attempts", "events", "unique_users", "difficulty_score")
        .orderBy(F.desc("difficulty_score"), F.desc("attempts"), F.desc("events"), "topic")
    )


def user_engagement(measures: DataFrame) -> DataFrame:
    """Activity totals and engagement band per user, busiest first."""
    return (
        roll_up(measures, "user_id", "topic")
        .groupBy("user_id")
        .agg(
            F.sum("events").alias("total_events"),
            mean(F.sum("score_total"), F.sum("scored")).alias("avg_score"),
            mean(F.sum("engagement_total"), F.sum("engagement_rows")).alias("avg_engagement"),
            F.sum("duration_seconds").alias("total_duration_seconds"),
            F.count("topic").alias("topics_covered"),
        )
        .withColumn(
            "engagement_band",
            band(F.col("total_events"), [(100, "high"), (25, "medium")], "emerging"),
        )
        .orderBy(F.desc("total_events"), F.desc("avg_score"), "user_id")
    )


def daily_activity(measures: DataFrame) -> DataFrame:
    """Events, active users, average and touched topics per day."""
    dated = measures.withColumn("event_date", F.to_date("event_hour"))
    return (
        roll_up(dated, "event_date", "user_id", "topic")
        .groupBy("event_date")
        .agg(
            F.sum("events").alias("events"),
            F.count_distinct("user_id").alias("active_users"),
            mean(F.sum("score_total"), F.sum("scored")).alias("avg_score"),
            F.count_distinct("topic").alias("topics_touched"),
        )
        .orderBy("event_date")
    )


def hourly_activity(measures: DataFrame) -> DataFrame:
    """Events and active users per hour and event type."""
    return (
        roll_up(measures, "event_hour", "event_type", "user_id")
        .groupBy("event_hour", "event_type")
        .agg(F.sum("events").alias("events"), F.count("user_id").alias("active_users"))
        .select(hour_label(F.col("event_hour")).alias("event_hour"), "event_type", "events", "active_users")
        .orderBy("event_hour", "event_type")
    )


def document_usage(documents: DataFrame) -> DataFrame:
    """Documents, total uses and average length per topic."""
    return (
        documents.groupBy("topic")
        .agg(
            F.count_distinct("document_id").alias("documents"),
            F.sum("usage_count").alias("total_usage"),
            mean(F.sum("content_words"), F.count("content_words")).alias("avg_words"),
        )
        .orderBy(F.desc("total_usage"), F.desc("documents"), "topic")
    )


def recommendation_features(measures: DataFrame) -> DataFrame:
    """Per user and topic: interactions, average, time, revision flag and skill band.

    Without any score the band is `weak`, and the flag depends on the count alone.
    """
    low = F.coalesce(F.col("avg_score") < 60, F.lit(False))
    return (
        roll_up(measures, "user_id", "topic")
        .select(
            "user_id", "topic",
            F.col("events").alias("interaction_count"),
            mean(F.col("score_total"), F.col("scored")).alias("avg_score"),
            F.col("duration_seconds").alias("time_spent_seconds"),
        )
        .withColumns({
            "recommend_revision": (low | (F.col("interaction_count") < 2)).cast("int"),
            "skill_band": band(F.col("avg_score"), [(80, "strong"), (60, "steady")], "weak"),
        })
    )


def learning_recommendations(metrics: DataFrame) -> DataFrame:
    """Advice per topic from its difficulty and average."""
    advice = (
        F.when(F.col("difficulty_score") >= 90, "Prioritize revision content and easier follow-up quiz.")
        .when(F.col("avg_score") < 60, "Schedule targeted review and a medium quiz.")
        .otherwise("Maintain progress with advanced practice.")
    )
    return metrics.select(
        "topic", "avg_score", "attempts", "difficulty_score", advice.alias("recommendation")
    )


def model_input(features: DataFrame) -> DataFrame:
    """Features with zeros for missing numbers, as the models need them."""
    return features.fillna({"avg_score": 0.0, "interaction_count": 0, "time_spent_seconds": 0})


def student_clusters(features: DataFrame, k: int = 3, seed: int = 42, method: str = "auto") -> DataFrame:
    """K-means cluster of every (user, topic) row.

    "auto" gives cluster -1 to all rows when they are alike or there are none, since k-means
    needs two different points; "model" fits in any case.
    """
    if method not in ("auto", "model"):
        raise ValueError("method is 'auto' or 'model'")
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    names = ["interaction_count", "avg_score", "time_spent_seconds"]
    filled = model_input(features)
    # Too few different points for k centres leaves nothing to cluster.
    if method == "auto" and filled.select(*names).distinct().limit(2).count() < 2:
        return filled.withColumn("cluster_id", F.lit(-1))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(filled)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster_id").fit(vectors)
    return model.transform(vectors).drop("features")


def performance_predictions(features: DataFrame, method: str = "auto", fit_from_rows: int = 4) -> DataFrame:
    """Predicted score by linear regression on count and time ("model") or by formula ("formula").

    "auto" takes the formula below `fit_from_rows` rows, where a regression means nothing.
    """
    if method not in ("auto", "model", "formula"):
        raise ValueError("method is 'auto', 'model' or 'formula'")
    if method == "formula":
        return formula_predictions(features)
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    filled = model_input(features)
    if method == "auto" and filled.limit(fit_from_rows).count() < fit_from_rows:
        return formula_predictions(features)
    assembler = VectorAssembler(
        inputCols=["interaction_count", "time_spent_seconds"], outputCol="features"
    )
    vectors = assembler.transform(filled)
    model = LinearRegression(
        featuresCol="features", labelCol="avg_score", predictionCol="predicted_score"
    ).fit(vectors)
    return model.transform(vectors).drop("features")


def formula_predictions(features: DataFrame) -> DataFrame:
    return model_input(features).withColumn(
        "predicted_score", formula_prediction(F.col("avg_score"), F.col("interaction_count"))
    )


def gold_tables(cube: DataFrame, documents: DataFrame, features: DataFrame | None = None) -> dict:
    """All nine Gold tables from the cube of timed events and the Silver documents.

    `features` are the recommendation features as written before, which the models then
    read instead of rolling them up again.
    """
    metrics = topic_metrics(cube)
    features = recommendation_features(cube) if features is None else features
    return {
        "topic_metrics": metrics,
        "user_engagement": user_engagement(cube),
        "daily_activity": daily_activity(cube),
        "hourly_activity": hourly_activity(cube),
        "document_usage": document_usage(documents),
        "recommendation_features": features,
        "student_clusters": student_clusters(features),
        "performance_predictions": performance_predictions(features),
        "learning_recommendations": learning_recommendations(metrics),
    }
