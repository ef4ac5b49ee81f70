"""Arithmetic that gives the same bits whatever the row order or engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(x: str | Column, digits: int) -> Column:
    """Round a double half away from zero on its binary value; never yields -0.0."""
    value = col(x).cast("double")
    scale = F.lit(float(10**digits))
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale + F.lit(0.0)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double, null when den is zero."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def percent(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """Share in percent, rounded."""
    return round_half_up(ratio(num, den) * F.lit(100.0), digits)


def floored_ratio(num: str | Column, den: str | Column) -> Column:
    """num / max(1, den): the reporting form that never divides by zero."""
    return col(num).cast("double") / F.greatest(F.lit(1.0), col(den).cast("double"))


def money_sum(x: str | Column) -> Column:
    """Exact decimal sum, returned as double."""
    return F.sum(col(x)).cast("double")


def mean(x: str | Column) -> Column:
    """Average from the exact decimal sum and the non-null count."""
    return F.try_divide(money_sum(x), F.count(col(x)).cast("double"))
