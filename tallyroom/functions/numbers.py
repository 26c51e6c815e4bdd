"""Rounding, banding and scoring rules as Column expressions."""

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, places: int) -> Column:
    """Round half up on a value first settled to ten decimals.

    Sums of doubles differ in their last bits with the order in which partial
    results arrive; settling first keeps a .xx5 average on one side of the tie
    whatever the task order or retries were.
    """
    return F.round(value.try_cast("decimal(28,10)"), places).cast("double")


def mean(total: Column, count: Column, places: int = 2) -> Column:
    """Rounded average from an already aggregated sum and count; NULL without rows."""
    return round_half_up(F.try_divide(total.cast("double"), count), places)


def band(value: Column, steps: list, otherwise) -> Column:
    """First label whose threshold `value` reaches; steps run from high to low."""
    chain = F
    for threshold, label in steps:
        chain = chain.when(value >= F.lit(threshold), F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def difficulty(avg_score: Column, events: Column) -> Column:
    """Distance of the average from 100, scaled by the natural log of the traffic."""
    missing_points = F.lit(100.0) - F.coalesce(avg_score, F.lit(0.0))
    return round_half_up(missing_points * F.ln(events + F.lit(1.0)), 2)


def recommended_level(avg_score: Column, attempts: Column) -> Column:
    """Quiz level for a learner: medium until there is a result to go by."""
    return F.when(attempts == 0, F.lit("medium")).otherwise(
        band(F.coalesce(avg_score, F.lit(0.0)), [(85, "hard"), (60, "medium")], "easy")
    )


def score_percent(score: Column, total_questions: Column) -> Column:
    """Share of correct answers in percent; zero questions count as one."""
    return round_half_up(
        score.cast("double") / F.greatest(total_questions.cast("long"), F.lit(1)) * F.lit(100), 2
    )


def formula_prediction(avg_score: Column, interactions: Column) -> Column:
    """Closed-form score forecast, used when there are too few rows to fit a model."""
    return round_half_up(avg_score * 0.75 + F.ln(interactions + F.lit(1.0)) * 6.0, 2)


def study_minutes(words: Column) -> Column:
    """Reading-time estimate in minutes, between 5 and 90."""
    return F.greatest(F.lit(5), F.least(F.lit(90), F.floor(words / 180))).cast("int")


def study_engagement(minutes: Column, words: Column) -> Column:
    """Minutes relative to the expected pace of 200 words a minute, at most 1."""
    pace = minutes / F.greatest(words / F.lit(200.0), F.lit(1.0))
    return round_half_up(F.least(F.lit(1.0), pace), 2)
