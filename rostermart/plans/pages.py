"""The data behind the report pages: one function per page, each part a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostermart.functions import bands
from rostermart.plans.filters import FilterContext, rows_in_context
from rostermart.plans.measures import (
    ALL, SCORECARD, average_monthly_attrition, distribution_all, evaluate, selected_distribution)
from rostermart.plans.star import Star
from rostermart.plans.trends import (
    SPARK_MEASURES, risk_history, sparklines, trend_with_reference, yoy_diversity)

# Rows per page of the two tables and the number of top factors.
RISK_ROWS = 15
DEPARTURE_ROWS = 20
TOP_FACTORS = 8


def rate_by(star: Star, column: str, context: FilterContext = ALL) -> DataFrame:
    """Attrition rate per value of a column, highest first."""
    rates = evaluate(star, ["attrition_rate_avg", "attrition_rate"], [column], context)
    return rates.orderBy(F.col("attrition_rate_avg").desc_nulls_last(), column)


def rate_by_tenure_band(star: Star, context: FilterContext = ALL) -> DataFrame:
    """Departures, headcount and rate per tenure band, shortest tenure first."""
    rows = rows_in_context(star, ["tenure_months"], context)
    banded = rows.select("headcount", "attrition_flag",
                         bands.tenure_band(F.col("tenure_months")).alias("tenure_band"),
                         bands.tenure_band_order(F.col("tenure_months")).alias("band_order"))
    sums = banded.groupBy("band_order", "tenure_band").agg(
        F.sum("headcount").alias("headcount"),
        F.nullif(F.count_if(F.col("attrition_flag") == 1), F.lit(0)).alias("departures"))
    return sums.withColumn("attrition_rate", F.try_divide(
        F.col("departures") * 100.0, F.col("headcount"))).orderBy("band_order")


def kpi_status(star: Star, context: FilterContext = ALL) -> DataFrame:
    """Department KPIs with their status bands and the risk target."""
    kpis = evaluate(star, ["attrition_rate", "avg_satisfaction", "predicted_risk"],
                    ["department_name"], context)
    return kpis.withColumns({
        "attrition_status": bands.attrition_status(F.col("attrition_rate")),
        "satisfaction_status": bands.satisfaction_status(F.col("avg_satisfaction")),
        "risk_status": bands.risk_status(F.col("predicted_risk")),
        "above_target": bands.above_target(F.col("predicted_risk"))})


def _after(rows: DataFrame, column: str, after: tuple | None) -> DataFrame:
    """Rows past the last one shown, in descending ``column`` and ascending employee key."""
    if after is None:
        return rows
    value, key = after
    later = (F.col(column) < F.lit(value)) | F.col(column).isNull()
    tied = (F.col(column) == F.lit(value)) & (F.col("employee_key") > key)
    return rows.where(later | tied)


def risk_table(star: Star, context: FilterContext = ALL, rows: int | None = RISK_ROWS,
               after: tuple | None = None) -> DataFrame:
    """Employees by falling probability, one page of them; ``after`` = last (probability, key) shown.

    Only the narrow fact columns are ordered and cut; names are joined to the
    page. ``rows=None`` gives the whole table unordered.
    """
    columns = ["employee_key", "job_role_key", "tenure_months", "satisfaction_score",
               "attrition_probability"]
    found = _after(rows_in_context(star, columns, context).select(*columns),
                   "attrition_probability", after)
    order = [F.col("attrition_probability").desc_nulls_last(), F.col("employee_key")]
    page = found if rows is None else found.orderBy(*order).limit(rows)
    named = (page.join(star.dimensions["employee"].select("employee_key", "full_name"), "employee_key")
             .join(star.dimensions["job_role"].select("job_role_key", "job_title"), "job_role_key"))
    shown = named.select("employee_key", "full_name", "job_title", "tenure_months", "satisfaction_score",
                         "attrition_probability",
                         bands.risk_level(F.col("attrition_probability")).alias("risk_level"))
    return shown if rows is None else shown.orderBy(*order)


def departure_records(star: Star, context: FilterContext = ALL, rows: int | None = DEPARTURE_ROWS,
                      after: tuple | None = None) -> DataFrame:
    """Departed employees, latest termination first; ``after`` = last (date, key) shown.

    As in ``risk_table``, a page is ordered and cut before names are joined.
    """
    columns = ["employee_key", "job_role_key", "termination_date", "tenure_months", "satisfaction_score",
               "overtime_hours"]
    left = rows_in_context(star, columns, context.where(attrition_flag=1)).select(*columns)
    left = _after(left, "termination_date", after)
    order = [F.col("termination_date").desc_nulls_last(), F.col("employee_key")]
    page = left if rows is None else left.orderBy(*order).limit(rows)
    people = star.dimensions["employee"].select("employee_key", "full_name", "hire_date", "salary_band")
    shown = (page.join(people, "employee_key")
             .join(star.dimensions["job_role"].select("job_role_key", "job_title"), "job_role_key")
             .select("employee_key", "full_name", "hire_date", "termination_date", "salary_band", "job_title",
                     "tenure_months", "satisfaction_score", "overtime_hours"))
    return shown if rows is None else shown.orderBy(*order)


def common_roles(star: Star, context: FilterContext = ALL) -> DataFrame:
    """The most frequent job title per department, all of them on a tie."""
    counts = rows_in_context(star, ["department_name", "job_title"], context).groupBy(
        "department_name", "job_title").agg(F.count("*").alias("n"))
    place = F.rank().over(Window.partitionBy("department_name").orderBy(F.col("n").desc()))
    return counts.withColumn("_place", place).where("_place = 1").drop("_place")


def top_factors(importance: DataFrame, n: int = TOP_FACTORS) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "position").limit(n)


def turnover_page(star: Star, context: FilterContext = ALL) -> dict[str, DataFrame]:
    return {
        "kpis": evaluate(star, ["attrition_rate_avg", "attrition_rate", "departures"], [], context),
        "average_monthly": average_monthly_attrition(star, [], context),
        "trend": trend_with_reference(star, [], context),
        "by_department": rate_by(star, "department_name", context),
        "by_job_role": rate_by(star, "job_title", context),
        "by_tenure": rate_by_tenure_band(star, context),
    }


def diversity_page(star: Star, selected: str | None = None, context: FilterContext = ALL) -> dict[str, DataFrame]:
    from rostermart.plans.measures import DIMENSION_SWITCH

    column = DIMENSION_SWITCH.get(selected or "", "gender")
    return {
        "by_department": selected_distribution(star, selected, ["department_name"], context),
        "overall": selected_distribution(star, selected, [], context),
        "all": distribution_all(star, context),
        "year_on_year": yoy_diversity(star, column, [], context).withColumn(
            "sign", bands.change_sign(F.col("change"))),
    }


def department_page(star: Star, context: FilterContext = ALL) -> dict[str, DataFrame]:
    return {
        "scorecard": evaluate(star, SCORECARD, ["department_name"], context),
        "status": kpi_status(star, context),
        "sparklines": sparklines(star, ["department_name"], context),
        "risk_table": risk_table(star, context),
    }


def departures_page(star: Star, department: str, context: FilterContext = ALL) -> dict[str, DataFrame]:
    """Drill-through on a department; all other filters stay."""
    inside = context.where(department_name=department)
    return {
        "kpis": evaluate(star, ["departures", "attrition_rate", "avg_tenure_at_departure"],
                         ["department_name"], inside),
        "common_role": common_roles(star, inside),
        "records": departure_records(star, inside),
    }


def employee_profiles(star: Star, context: FilterContext = ALL) -> DataFrame:
    """Who the employee is, where, and how high the risk: one row per fact in the context."""
    columns = ["employee_key", "full_name", "department_name", "job_title", "city", "region",
               "tenure_months", "attrition_probability", "satisfaction_score", "overtime_hours",
               "salary_band", "promotion_recent"]
    return rows_in_context(star, columns, context).select(*columns).withColumns({
        "risk_level": bands.risk_level(F.col("attrition_probability")),
        "above_target": bands.above_target(F.col("attrition_probability"))})


def risk_profile_page(star: Star, employee_key: int, importance: DataFrame,
                      context: FilterContext = ALL) -> dict[str, DataFrame]:
    """Drill-through on one employee, as far as the star's rights go."""
    return {
        "profile": employee_profiles(star, context.where(employee_key=employee_key)),
        "factors": top_factors(importance),
        "history": risk_history(star.history, [employee_key]),
    }


__all__ = [
    "SPARK_MEASURES", "common_roles", "department_page", "departure_records", "departures_page",
    "diversity_page", "kpi_status", "rate_by", "rate_by_tenure_band", "risk_profile_page",
    "risk_table", "top_factors", "turnover_page",
]
