"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import col


def week_start(d: str | Column) -> Column:
    """Monday of the week, as a date."""
    return F.date_trunc("week", col(d)).cast("date")


def weeks_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole weeks between two dates."""
    return (F.date_diff(col(later), col(earlier)) / F.lit(7)).cast("int")


def micros(ts: str | Column) -> Column:
    """Event time as microseconds since the epoch."""
    return F.unix_micros(col(ts).cast("timestamp"))


def from_micros(us: str | Column) -> Column:
    return F.timestamp_micros(col(us))


def seconds_to_micros(seconds: float) -> int:
    return int(round(seconds * 1_000_000))
