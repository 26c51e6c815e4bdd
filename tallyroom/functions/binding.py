"""Evaluate an expensive column expression once."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` applied to `value`, with `value` computed once per row.

    Inside the lambda of a higher-order function an outer expression is computed
    again for every element, and the optimizer may move a projected column into
    such a lambda. Binding the value to a lambda variable prevents both.
    """
    return F.transform(F.array(value), lambda bound: body(bound))[0]


def rows_of(frame: DataFrame, columns: list, array: Column, name: str, pos: str | None = None) -> DataFrame:
    """One row per element of `array`, next to `columns`; `pos` also names its 0-based position.

    An inner explode makes the optimizer test the array for emptiness beforehand,
    which computes an expensive array expression again. The outer form with the
    padding rows removed gives the same rows and computes it once.
    """
    place = pos or "__pos"
    rows = frame.select(*columns, F.posexplode_outer(array).alias(place, name)).where(F.col(place).isNotNull())
    return rows if pos else rows.drop(place)


def runs(values: Column, differ: Callable[[Column, Column], Column]) -> Column:
    """Array of (first, size) of the runs of neighbours that do not differ; `first` counts from 0.

    `values` must be bound (`let`), as it is looked up once per element.
    """
    starts = F.array_compact(F.transform(
        values, lambda v, i: F.when((i == 0) | differ(F.get(values, i - 1), v), i)))
    return let(starts, lambda at: F.transform(at, lambda first, i: F.struct(
        first.alias("first"), (F.coalesce(F.get(at, i + 1), F.size(values)) - first).alias("size"))))


def run_of(values: Column, run: Column) -> Column:
    """The elements of one run. (`slice` would copy all of `values` first.)"""
    return F.transform(F.sequence(run["first"], run["first"] + run["size"] - 1), lambda i: F.get(values, i))
