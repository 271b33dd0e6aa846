"""Employee records, staging and star made from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermart.config import JobSpec
from rostermart.operators.features import derive_features
from rostermart.operators.latest import keep_latest
from rostermart.plans.star import Star, to_staging
from rostermart.sources import scratch
from rostermart.sources.star_store import StarStore

AS_OF = dt.date(2002, 1, 1)
FIRST_AS_OF = dt.date(2000, 7, 1)
FIRST_BATCH_END = dt.date(2000, 7, 1)
LOAD_TIME = dt.datetime(2002, 1, 1)
JOB = JobSpec.default()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_orders(orders: DataFrame) -> DataFrame:
    """The columns that change from record to record."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    return orders.select(
        F.col("o_custkey").alias("employee_id"), key.alias("src_ordinal"),
        F.col("o_orderpriority").alias("job_role"), day.alias("hire_date"),
        F.col("o_totalprice").alias("salary"),
        ((10 + key % 41).cast("double") / 10).alias("satisfaction_score"),
        (key % 31).cast("int").alias("overtime_hours"),
        F.when(key % 5 < 2, F.date_add(day, 400)).alias("promotion_date"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("attrition"),
        ((key % 50).cast("double") / 100).alias("attrition_probability"))


def place_text() -> Column:
    nation, region = F.col("n_name"), F.col("r_name")
    return (F.when(F.col("n_nationkey") % 3 == 0, nation)
            .when(F.col("n_nationkey") % 3 == 1, F.concat(nation, F.lit(", "), region))
            .otherwise(F.concat(nation, F.lit(", "), region, F.lit(", EARTH"))))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that belong to a person."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("c_custkey")
    return customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("employee_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("department"),
        (20 + key % 45).cast("int").alias("age"),
        F.when(key % 3 == 0, "Male").when(key % 3 == 1, "Female").otherwise("Non-Binary").alias("gender"),
        F.col("r_name").alias("ethnicity"), place_text().alias("location"))


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record, several per person."""
    return from_orders(table(spark, sf_dir, "orders")).join(people(spark, sf_dir), "employee_id")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest record per person; repeats go before the join, so a hot person does not reach it."""
    records = from_orders(table(spark, sf_dir, "orders"))
    latest = keep_latest(records, "employee_id", "hire_date", [F.col("src_ordinal").desc()])
    return latest.join(people(spark, sf_dir).hint("merge"), "employee_id")  # as many people as records, too many to broadcast


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_features(employees(spark, sf_dir), JOB.clean.features, AS_OF)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_staging(featured(spark, sf_dir), LOAD_TIME)


_stores: dict[tuple[str, str, str], StarStore] = {}


def _store(spark: SparkSession, sf_dir: str, kind: str, fill) -> StarStore:
    """One store per session, data folder and kind, loaded at first use in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _stores:
        store = StarStore(spark, scratch.new_path(spark, f"star-{kind}"))
        fill(store)
        _stores[key] = store
    return _stores[key]


def store(spark: SparkSession, sf_dir: str) -> StarStore:
    """One load of the whole staging table."""
    return _store(spark, sf_dir, "one", lambda s: s.load(staging(spark, sf_dir), AS_OF))


def first_batch(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("hire_date") < F.lit(FIRST_BATCH_END))


def store_of_three_loads(spark: SparkSession, sf_dir: str) -> StarStore:
    """Hires before July 2000 first, then everybody, then everybody again."""

    def fill(s: StarStore) -> None:
        rows = scratch.saved(staging(spark, sf_dir), "staging")
        s.load(first_batch(rows), FIRST_AS_OF)
        s.load(rows, AS_OF)
        s.load(rows, AS_OF)

    return _store(spark, sf_dir, "three", fill)


def late(rows: DataFrame) -> DataFrame:
    """One employee of a hundred, with another salary."""
    return rows.where(F.col("employee_id").cast("long") % 100 == 0).withColumn("salary", F.lit(1).cast("decimal(12,2)"))


def store_with_late_rows(spark: SparkSession, sf_dir: str) -> StarStore:
    """Everybody, then a hundredth of them again."""

    def fill(s: StarStore) -> None:
        rows = scratch.saved(staging(spark, sf_dir), "staging")
        s.load(rows, AS_OF)
        s.load(late(rows), AS_OF)

    return _store(spark, sf_dir, "late", fill)


def star(spark: SparkSession, sf_dir: str) -> Star:
    return store(spark, sf_dir).star()
