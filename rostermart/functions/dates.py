"""Date keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_parts(day: Column) -> dict[str, Column]:
    """The attributes of one calendar day; weeks start on Sunday = 1."""
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_week": F.dayofweek(day),
        "is_month_end": F.coalesce((F.last_day(day) == day).cast("int"), F.lit(0)),
    }


def calendar_rows(days: DataFrame, column: str) -> DataFrame:
    """One calendar row for each distinct non-null day."""
    distinct_days = days.select(F.col(column).alias("_day")).where("_day is not null").distinct()
    return distinct_days.select(*[c.alias(n) for n, c in date_parts(F.col("_day")).items()])


def dense_calendar(days: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last, without gaps."""
    span = days.agg(F.min(column).alias("first"), F.max(column).alias("last")).where("first is not null")
    return calendar_rows(span.select(F.explode(F.sequence("first", "last")).alias("day")), "day")
