"""Full refresh: name-only dimensions and a fact without dates, built anew each time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.operators.merge import insert_absent
from rostermart.operators.ordering import dense_ids
from rostermart.session import side_by_side
from rostermart.sources import scratch

EMPLOYEE_COLUMNS = ("employee_id", "name", "gender", "ethnicity", "age", "age_group", "hire_date",
                    "salary_band")


def refresh_star(staging: DataFrame, root: str | None = None) -> dict[str, DataFrame]:
    """Dimensions by insert-if-absent into empty tables, then the fact by inner joins.

    The tables are written below ``root`` (default: the scratch folder) and
    returned as read back.
    """
    root = root or scratch.new_path(staging.sparkSession, "refresh")

    def stored(name: str, df: DataFrame) -> DataFrame:
        path = f"{root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return staging.sparkSession.read.schema(df.schema).parquet(path)

    def dimension(name: str, source: DataFrame, natural: str) -> DataFrame:
        known = source.where(F.col(natural).isNotNull())
        return stored(f"dim_{name}", insert_absent(None, known, [natural], f"{name}_key"))

    def names(column: str, as_name: str) -> DataFrame:
        return staging.select(F.col(column).alias(as_name))

    tables = side_by_side(staging.sparkSession, {
        "dim_department": lambda: dimension(
            "department", names("department", "department_name"), "department_name"),
        "dim_job_role": lambda: dimension("job_role", names("job_role", "job_title"), "job_title"),
        "dim_location": lambda: dimension("location", names("location", "location_name"), "location_name"),
        "dim_employee": lambda: dimension("employee", staging.select(*EMPLOYEE_COLUMNS), "employee_id"),
    })
    joined = (
        staging.join(tables["dim_employee"].select("employee_id", "employee_key"), "employee_id")
        .join(tables["dim_department"].withColumnRenamed("department_name", "department"), "department")
        .join(tables["dim_job_role"].withColumnRenamed("job_title", "job_role"), "job_role")
        .join(tables["dim_location"].withColumnRenamed("location_name", "location"), "location"))
    fact = joined.select(
        "employee_key", "department_key", "job_role_key", "location_key",
        F.col("attrition").alias("attrition_flag"), F.lit(1).alias("headcount"),
        F.col("tenure_months").cast("decimal(6,1)"), F.col("satisfaction_score").cast("decimal(3,1)"),
        F.col("salary").cast("decimal(12,2)"), "overtime_hours", "overtime_flag")
    tables["fact"] = stored("fact", dense_ids(
        fact, ["employee_key", "department_key", "job_role_key", "location_key"], "metric_id"))
    return tables
