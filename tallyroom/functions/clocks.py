"""Time expressions."""

from pyspark.sql import Column, functions as F


def parse_ts(value: Column) -> Column:
    """Text to timestamp; what does not parse becomes NULL instead of an error."""
    return F.try_to_timestamp(value)


def hour_label(ts: Column) -> Column:
    """Hour bucket as the text `yyyy-MM-dd HH:00:00`."""
    return F.date_format(F.date_trunc("hour", ts), "yyyy-MM-dd HH:mm:ss")


def time_of(frame, name: str) -> Column:
    """A column as timestamp, whether it holds ISO text or already a time."""
    column = F.col(name)
    kind = frame.schema[name].dataType.typeName()
    return parse_ts(column) if kind == "string" else column.cast("timestamp")


def day_or_latest(frame, day, name: str) -> Column:
    """`day` as a date, or the newest date in `frame[name]` when it is not given."""
    if day is not None:
        return F.lit(day).cast("date")
    return frame.agg(F.max(F.to_date(time_of(frame, name)))).scalar()
