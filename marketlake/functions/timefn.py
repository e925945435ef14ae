"""Time expressions. Text that is no timestamp gives null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts(text: Column) -> Column:
    return F.try_to_timestamp(text)


def earliest_first(text: Column) -> Column:
    """A sort key by time, whatever the text's offset and precision; what is no time comes last."""
    at = parse_ts(text).cast("timestamp")
    return F.struct(at.isNull().alias("none"), at.alias("at"))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; a TIMESTAMP_NTZ is read in the session zone."""
    return F.unix_micros(ts.cast("timestamp"))


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:00")


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def months_apart(start: Column, end: Column) -> Column:
    """Whole months between two month starts."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("bigint")


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5
