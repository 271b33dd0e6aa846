"""Ratios, shares and averages whose value does not depend on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(numerator: Column, denominator: Column, on_zero: float | None = None) -> Column:
    """Quotient as double; ``on_zero`` (default null) where the denominator is 0."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    if on_zero is None:
        return quotient
    return F.when(denominator == 0, F.lit(float(on_zero))).otherwise(quotient)


def percent(part: Column, whole: Column, on_zero: float | None = None) -> Column:
    return safe_divide(part * 100, whole, on_zero)


def mean(value: Column) -> Column:
    """Average over non-null values from an exact sum (decimals stay exact)."""
    return safe_divide(F.sum(value), F.count(value))


def blank_if_zero(count: Column, blank: bool) -> Column:
    """A count of no rows is blank (null) in measures and 0 in the SQL views."""
    return F.nullif(count, F.lit(0)) if blank else count


def tenth_percent(part: Column, whole: Column) -> Column:
    """Percentage rounded half up to one place, in whole numbers until the last step."""
    doubled, twice = part * 2000 + whole, whole * 2
    return F.when(whole != 0, (doubled - doubled % twice) / twice / 10)
