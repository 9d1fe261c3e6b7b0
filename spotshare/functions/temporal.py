"""Days, months and open validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def day_to_timestamp(day: Column) -> Column:
    """Day text (anything after ``yyyy-MM-dd`` is ignored) to midnight of that day; NULL when unreadable."""
    return F.try_to_timestamp(F.substring(day, 1, 10), F.lit("yyyy-MM-dd"))


def epoch_seconds(ts: Column) -> Column:
    return ts.cast("timestamp").cast("bigint")


def month_key(day: Column) -> Column:
    """``yyyy-MM`` partition key."""
    return F.date_format(day, "yyyy-MM")


def current_month(zone: str = "Europe/Madrid") -> Column:
    """Month of the current instant on the clock of ``zone``, whatever the session time zone."""
    return F.date_format(F.convert_timezone(None, F.lit(zone), F.localtimestamp()), "yyyy-MM")


def moment(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a timestamp: epoch seconds, day text, dates and timestamps are accepted."""
    kind = dict(df.dtypes)[name]
    if kind in ("bigint", "int"):
        return F.timestamp_seconds(F.col(name))
    if kind == "string":
        return day_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def inside(at: Column, start: Column, end: Column) -> Column:
    """Open interval test: both end points are outside."""
    return (at > start) & (at < end)
