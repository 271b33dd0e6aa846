"""Turnover, department and diversity measures over the star."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermart.functions.ratios import blank_if_zero, mean, percent, safe_divide, tenth_percent
from rostermart.operators.ordering import quantiles
from rostermart.plans.filters import DEMOGRAPHICS, HOME, FilterContext, rows_in_context
from rostermart.plans.star import Star
from rostermart.session import side_by_side

ALL = FilterContext()


def _departed() -> Column:
    return F.col("attrition_flag") == 1


def departures(blank: bool = True) -> Column:
    return blank_if_zero(F.count_if(_departed()), blank)


# Each measure is one aggregate expression; ``blank`` says whether a count of no
# rows is null (report measures) or 0 (SQL views).
MEASURES: dict[str, Callable[[bool], Column]] = {
    "headcount": lambda blank: F.sum("headcount"),
    "departures": departures,
    "open_positions": departures,
    # Departures over the average of the headcount column. That column is 1 in every
    # row, so this is departures times 100; attrition_rate is the share.
    "attrition_rate_avg": lambda blank: safe_divide(departures(blank) * 100, F.avg("headcount")),
    "attrition_rate": lambda blank: percent(departures(blank), F.sum("headcount")),
    "avg_tenure": lambda blank: mean(F.col("tenure_months")),
    "avg_satisfaction": lambda blank: mean(F.col("satisfaction_score")),
    "predicted_risk": lambda blank: mean(F.col("attrition_probability")),
    "avg_tenure_at_departure": lambda blank: mean(F.when(_departed(), F.col("tenure_months"))),
}
SCORECARD = ("headcount", "attrition_rate", "avg_tenure", "avg_satisfaction", "open_positions",
             "predicted_risk")


def evaluate(star: Star, names: Sequence[str], by: Sequence[str] = (), context: FilterContext = ALL,
             blank_as_null: bool = True) -> DataFrame:
    """The named measures per group of ``by``: one scan, one partial aggregate."""
    unknown = [n for n in names if n not in MEASURES]
    if unknown:
        raise ValueError("Unknown measures: " + ", ".join(unknown))
    rows = rows_in_context(star, by, context)
    return rows.groupBy(*by).agg(*[MEASURES[n](blank_as_null).alias(n) for n in names])


def distinct_values(star: Star, column: str, context: FilterContext = ALL) -> DataFrame:
    """The values of a column that have facts in the context."""
    return rows_in_context(star, [column], context).select(column).distinct()


def turnover_summary(star: Star, context: FilterContext = ALL) -> DataFrame:
    """Headcount, departures and rate per year, month and department; 0 for no headcount."""
    rows = rows_in_context(star, ["year", "month", "department_name"], context)
    sums = rows.groupBy("year", "month", "department_name").agg(
        F.sum("headcount").alias("headcount"), F.sum("attrition_flag").alias("departures"))
    return sums.withColumn("turnover_rate", percent(F.col("departures"), F.col("headcount"), on_zero=0))


def turnover_by_department(star: Star) -> DataFrame:
    """Headcount, departures and rate to one place per department, highest rate first."""
    rows = rows_in_context(star, ["department_name"], ALL)
    sums = rows.groupBy("department_name").agg(
        F.count("*").alias("headcount"), F.sum("attrition_flag").alias("departures"))
    rate = tenth_percent(F.col("departures"), F.col("headcount"))
    return sums.withColumn("turnover_rate_pct", rate).orderBy(
        F.col("turnover_rate_pct").desc(), "department_name")


def diversity_counts(star: Star, context: FilterContext = ALL) -> DataFrame:
    """Headcount per department, gender, ethnicity and age group."""
    group = ["department_name", *DEMOGRAPHICS]
    return rows_in_context(star, group, context).groupBy(*group).agg(F.count("*").alias("headcount"))


def diversity_metrics(star: Star, context: FilterContext = ALL) -> DataFrame:
    """The counts with their share of the department, summed over the groups, not over facts again."""
    whole = F.sum("headcount").over(Window.partitionBy("department_name"))
    return diversity_counts(star, context).withColumn(
        "percentage", percent(F.col("headcount"), whole, on_zero=0))


def distribution(star: Star, column: str, by: Sequence[str] = (), context: FilterContext = ALL) -> DataFrame:
    """Share of each value of a demographic column: ``(*by, column, n, total, pct)``.

    The numerator drops every employee filter but the one on ``column``; the
    denominator drops only that one. Both come from the same scan by
    conditional counts, so with a second employee filter on they differ and a
    share can pass 100.
    """
    if HOME.get(column) != "employee":
        raise ValueError(f"Not an employee column: {column}")
    employee = [c for c in context.columns if HOME.get(c) == "employee"]
    own, others = context.only([column]), context.only([c for c in employee if c != column])
    outer = [c for c in by if HOME.get(c) != "employee"]
    rows = rows_in_context(star, [*by, column], context, tests_later=employee)
    counted = rows.groupBy(*by, column).agg(
        F.count_if(own.test()).alias("part"), F.count_if(others.test()).alias("rest"))
    if by:
        whole = counted.withColumn("whole", F.sum("rest").over(Window.partitionBy(*by)))
    else:  # one row for the total, whatever the number of values
        whole = counted.withColumn("whole", counted.agg(F.sum("rest")).scalar())
    shares = whole.select(
        *by, column,
        F.nullif(F.sum("part").over(Window.partitionBy(*outer, column)), F.lit(0)).alias("n"),
        F.nullif("whole", F.lit(0)).alias("total"))
    shown = shares.withColumn("pct", percent(F.col("n"), F.col("total")))
    return shown.where("n is not null")


# Names of the dimension switch.
DIMENSION_SWITCH = {"Gender": "gender", "Ethnicity": "ethnicity", "Age Group": "age_group"}


def selected_distribution(star: Star, selected: str | None, by: Sequence[str] = (),
                          context: FilterContext = ALL) -> DataFrame:
    """Distribution of the switched dimension; an unknown name means Gender."""
    column = DIMENSION_SWITCH.get(selected or "", "gender")
    return distribution(star, column, by, context).withColumnRenamed(column, "category")


def distribution_all(star: Star, context: FilterContext = ALL) -> DataFrame:
    """All three distributions per department and overall: ``(department_name, dimension, category, n, pct)``.

    Facts are counted once by all four columns; the six groupings run over
    those counts. The overall rows have a null department.
    """
    counts = diversity_counts(star, context)
    department, (gender, ethnicity, age) = F.col("department_name"), [F.col(c) for c in DEMOGRAPHICS]
    sets = [[department, gender], [department, ethnicity], [department, age], [gender], [ethnicity], [age]]
    grouped = counts.groupingSets(sets, department, gender, ethnicity, age).agg(
        F.sum("headcount").alias("n"), F.grouping_id().alias("level"))
    # grouping_id has a bit per column, from the left, that is 1 where it is summed over.
    level = F.col("level")
    overall = level.bitwiseAND(F.lit(8)) != 0
    dimension = (F.when(level.bitwiseAND(F.lit(4)) == 0, "Gender")
                 .when(level.bitwiseAND(F.lit(2)) == 0, "Ethnicity").otherwise("Age Group"))
    long = grouped.select(
        F.when(~overall, department).alias("department_name"), overall.alias("overall"),
        dimension.alias("dimension"),
        F.when(dimension == "Gender", gender).when(dimension == "Ethnicity", ethnicity)
        .otherwise(age).alias("category"), "n")
    whole = F.sum("n").over(Window.partitionBy("overall", "department_name", "dimension"))
    return long.withColumn("pct", percent(F.col("n"), whole)).drop("overall")


def distribution_matrix(star: Star, column: str, values: Sequence[str],
                        context: FilterContext = ALL) -> DataFrame:
    """Departments by category shares plus an overall row (null department)."""
    counts = rows_in_context(star, ["department_name", column], context).groupBy(
        "department_name", column).agg(F.count("*").alias("n"))
    grouped = counts.groupingSets(
        [[F.col("department_name"), F.col(column)], [F.col(column)]], F.col("department_name"),
        F.col(column)).agg(F.sum("n").alias("n"), F.grouping("department_name").alias("is_total"))
    whole = Window.partitionBy("is_total", "department_name")
    shares = grouped.withColumn("pct", percent(F.col("n"), F.sum("n").over(whole)))
    return shares.groupBy("is_total", "department_name").pivot(column, list(values)).agg(F.first("pct"))


def average_monthly_attrition(star: Star, by: Sequence[str] = (), context: FilterContext = ALL) -> DataFrame:
    """Mean over the month numbers 1 to 12 of the monthly rate; months without departures are blank."""
    monthly = evaluate(star, ["attrition_rate"], [*by, "month"], context)
    return monthly.groupBy(*by).agg(F.avg("attrition_rate").alias("avg_monthly_attrition"))


def employee_profile(staging: DataFrame, approximate: bool = False) -> DataFrame:
    """Summary of the staging table in long form: ``(section, item, metric, value)``.

    Attrition and promotion rates, rows per department, and count, mean, sample
    deviation, extremes and quartiles of salary and satisfaction.
    """
    spark = staging.sparkSession
    numbers = ["salary", "satisfaction_score"]
    one = staging.agg(
        mean(F.col("attrition")).alias("attrition_rate"),
        safe_divide(F.count("promotion_date"), F.count("*")).alias("promotion_rate"),
        *[f.alias(f"{c}:{m}") for c in numbers for m, f in {
            "count": F.count(c).cast("double"), "mean": mean(F.col(c)),
            "std": F.stddev_samp(F.col(c).cast("double")),
            "min": F.min(c).cast("double"), "max": F.max(c).cast("double")}.items()])
    cells = [("overall", "", "attrition_rate", F.col("attrition_rate")),
             ("overall", "", "promotion_rate", F.col("promotion_rate"))]
    cells += [("describe", c, m, F.col(f"`{c}:{m}`")) for c in numbers
              for m in ("count", "mean", "std", "min", "max")]
    flat = one.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("item"), F.lit(m).alias("metric"),
                 v.alias("value")) for s, i, m, v in cells])))
    found = side_by_side(spark, {
        c: partial(quantiles, staging, c, [0.25, 0.5, 0.75], approximate) for c in numbers})
    quartiles = [("describe", c, name, value) for c in numbers
                 for name, value in zip(("25%", "50%", "75%"), found[c], strict=True)]
    spread = spark.createDataFrame(quartiles, "section string, item string, metric string, value double")
    departments = staging.groupBy("department").agg(F.count("*").cast("double").alias("value")).select(
        F.lit("department").alias("section"), F.col("department").alias("item"),
        F.lit("rows").alias("metric"), "value")
    return flat.unionByName(spread).unionByName(departments)
