"""Comparisons over time: year on year, rolling months, sparklines, histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermart.functions.bands import RISK_REFERENCE
from rostermart.functions.dates import date_key
from rostermart.functions.ratios import mean, percent, safe_divide
from rostermart.plans.filters import DEMOGRAPHICS, FilterContext, rows_in_context
from rostermart.plans.measures import ALL, MEASURES, evaluate
from rostermart.plans.star import PARTITION, Star


def month_index(year: Column, month: Column) -> Column:
    return year * 12 + month


def yoy_diversity(star: Star, column: str, by: Sequence[str] = (), context: FilterContext = ALL) -> DataFrame:
    """Share of each category this year minus last year, in percentage points.

    ``(*by, year, category, share, previous_share, change)``. Years are matched
    by number, so a year without facts gives null rather than the year before
    it. A category that is gone this year counts as 0; one that is new has no
    previous share and no change.
    """
    demographic = [c for c in context.columns if c in DEMOGRAPHICS]
    rows = rows_in_context(star, [*by, "year", column], context, tests_later=demographic)
    counted = rows.groupBy(*by, "year", F.col(column).alias("category")).agg(
        F.count_if(context.only(demographic).test()).alias("n"), F.count("*").alias("all_n"))
    total = F.sum("all_n").over(Window.partitionBy(*by, "year"))
    shares = counted.select(*by, "year", "category",
                            percent(F.nullif("n", F.lit(0)), total).alias("share"))
    shares = shares.where("share is not null")
    # Every share counts in its own year and as the previous share of the next one.
    blank = F.lit(None).cast("double")
    pairs = shares.select(*by, "category", F.inline(F.array(
        F.struct("year", "share", blank.alias("previous_share")),
        F.struct((F.col("year") + 1).alias("year"), blank.alias("share"),
                 F.col("share").alias("previous_share")))))
    paired = pairs.groupBy(*by, "year", "category").agg(
        F.max("share").alias("share"), F.max("previous_share").alias("previous_share"))
    years = star.dimensions["date"].select("year").distinct()
    change = F.when(F.col("previous_share").isNotNull(),
                    F.coalesce("share", F.lit(0.0)) - F.col("previous_share"))
    return paired.join(years, "year", "left_semi").select(
        *by, "year", "category", "share", "previous_share", change.alias("change"))


def monthly(star: Star, by: Sequence[str], names: Sequence[str], context: FilterContext = ALL) -> DataFrame:
    """Measures per group and calendar month, with the running month index."""
    rows = evaluate(star, names, [*by, "year", "month"], context)
    return rows.withColumn("month_index", month_index(F.col("year"), F.col("month")))


def rolling_months(star: Star, by: Sequence[str] = ("department_name",), months: int = 12,
                   context: FilterContext = ALL) -> DataFrame:
    """Headcount, departures, rate and mean satisfaction over the last ``months`` months at each month.

    Facts are first summed by month; the window runs over those sums by month
    index, so months without facts count as passed. Averages carry sum and
    count and divide last.
    """
    rows = rows_in_context(star, [*by, "year", "month"], context)
    sums = rows.groupBy(*by, "year", "month").agg(
        F.sum("headcount").alias("h"), F.count_if(F.col("attrition_flag") == 1).alias("d"),
        F.sum("satisfaction_score").alias("s"), F.count("satisfaction_score").alias("c"))
    frame = (Window.partitionBy(*by).orderBy(month_index(F.col("year"), F.col("month")))
             .rangeBetween(-(months - 1), 0))
    rolled = sums.select(*by, "year", "month", *[F.sum(x).over(frame).alias(x) for x in "hdsc"])
    return rolled.select(
        *by, "year", "month", F.col("h").alias("headcount_rolling"),
        F.col("d").alias("departures_rolling"),
        percent(F.nullif("d", F.lit(0)), F.col("h")).alias("attrition_rate_rolling"),
        safe_divide(F.col("s"), F.col("c")).alias("avg_satisfaction_rolling"))


SPARK_MEASURES = ("headcount", "attrition_rate", "avg_tenure", "avg_satisfaction", "open_positions")


def sparklines(star: Star, by: Sequence[str] = ("department_name",), context: FilterContext = ALL) -> DataFrame:
    """Five measures per group and month over the twelve months to the last calendar day.

    Long form ``(*by, year, month, measure, value, is_min, is_max)``. Any date
    condition of the context is ignored. The last day is a scalar subquery over
    the calendar, the same for all groups.
    """
    calendar = star.dimensions["date"]
    last = calendar.select(F.max("full_date")).scalar()
    before = F.add_months(last, -12)
    # The same bound on the fact's own columns prunes year folders and row groups.
    recent_fact = star.fact.where((F.col(PARTITION) >= F.year(before)) & (F.col("date_key") > date_key(before)))
    rows = rows_in_context(star.with_fact(recent_fact), [*by, "full_date", "year", "month"],
                           context.without_table("date"))
    recent = rows.where((F.col("full_date") > before) & (F.col("full_date") <= last))
    wide = recent.groupBy(*by, "year", "month").agg(
        *[MEASURES[m](True).cast("double").alias(m) for m in SPARK_MEASURES])
    long = wide.unpivot([*by, "year", "month"], list(SPARK_MEASURES), "measure", "value")
    line = Window.partitionBy(*by, "measure")
    return long.where("value is not null").select(
        "*", (F.col("value") == F.min("value").over(line)).cast("int").alias("is_min"),
        (F.col("value") == F.max("value").over(line)).cast("int").alias("is_max"))


def trend_with_reference(star: Star, by: Sequence[str] = (), context: FilterContext = ALL,
                         reference: str = "attrition_rate") -> DataFrame:
    """Monthly attrition rate with the whole period's ``reference`` measure as a constant."""
    monthly = evaluate(star, ["attrition_rate"], [*by, "year", "month"], context)
    whole = evaluate(star, [reference], [*by], context).withColumnRenamed(reference, "reference_rate")
    if not by:
        return monthly.withColumn("reference_rate", whole.scalar())
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"w.{c}")) for c in by]
    return monthly.alias("m").join(whole.alias("w"), same).select("m.*", "w.reference_rate")


def risk_history(history: DataFrame, employee_keys: Sequence[int] | None = None) -> DataFrame:
    """Mean predicted probability per employee and month of load, with the reference line."""
    if employee_keys is not None:
        history = history.where(F.col("employee_key").isin(*employee_keys))
    points = history.groupBy("employee_key", F.year("as_of").alias("year"), F.month("as_of").alias("month"))
    return points.agg(mean(F.col("attrition_probability")).alias("attrition_probability")).withColumn(
        "reference", F.lit(RISK_REFERENCE))
