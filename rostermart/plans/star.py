"""The star: tables in memory as DataFrames, their sources, and the fact join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.functions.dates import calendar_rows, date_key
from rostermart.functions.places import UNKNOWN, place_parts
from rostermart.operators.merge import beside
from rostermart.schemas import DIMENSIONS, FACT, KEY_OF, STAGING

# Attributes the staging data does not carry.
TO_BE_DEFINED = "TBD"
JOB_LEVEL = "Standard"
JOB_FAMILY = "General"
HEADCOUNT = 1

PARTITION = "date_year"


@dataclass(frozen=True)
class Star:
    """Fact, dimensions and the risk history (one row per employee and load); ``restricted`` marks a star narrowed by access rights."""

    fact: DataFrame
    dimensions: dict[str, DataFrame]
    history: DataFrame | None = None
    restricted: bool = False
    # What visible facts are joined with: their keys lead to visible rows alone, so the narrowing is not repeated.
    _whole: dict[str, DataFrame] | None = None

    def dimension(self, name: str) -> DataFrame:
        """A dimension as the user may see it."""
        return self.dimensions[name]

    def narrowed(self, fact: DataFrame, departments: DataFrame) -> Star:
        """Only these facts and departments; the dimensions (but for days) and the history follow the facts."""
        used = {n: fact.select(KEY_OF[n]).distinct() for n in ("employee", "job_role", "location")}
        seen = {n: self.dimensions[n].join(keys, KEY_OF[n], "left_semi") for n, keys in used.items()}
        history = None if self.history is None else self.history.join(used["employee"], "employee_key", "left_semi")
        return Star(fact, {**self.dimensions, **seen, "department": departments}, history, True, self._whole or self.dimensions)

    def with_fact(self, fact: DataFrame) -> Star:
        return replace(self, fact=fact)

    def joined(self, needed: dict[str, Sequence[str]]) -> DataFrame:
        """Facts with the wanted columns of the wanted dimensions.

        No join hint: the dimensions are written tables, so Spark broadcasts
        the ones that are small enough by file size and shuffles the rest. The
        employees come first, as the one dimension that grows with the facts:
        a shuffle then carries keys and numbers but no names.
        """
        rows = self.fact
        for name in sorted(needed, key=lambda n: n != "employee"):
            key = KEY_OF[name]
            wanted = [c for c in needed[name] if c != key]
            rows = rows.join((self._whole or self.dimensions)[name].select(key, *wanted), key)
        return rows


def to_staging(df: DataFrame, load_time: dt.datetime) -> DataFrame:
    """Project to the staging schema; values that do not fit become null, absent columns too."""
    chosen = []
    for name, kind in STAGING.items():
        if name == "load_timestamp":
            value = F.lit(load_time)
        elif name in df.columns:
            value = F.col(name).try_cast(kind)
        else:
            value = F.lit(None).cast(kind)
        chosen.append(value.alias(name))
    return df.select(*chosen)


def misfits(df: DataFrame) -> dict[str, int]:
    """Per staging column, the values that are there and do not fit; columns without any are left out."""
    names = [c for c in STAGING if c in df.columns]
    lost = df.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(STAGING[c]).isNull()).alias(c) for c in names]).first()
    return {c: lost[c] for c in names if lost[c]}


def department_source(staging: DataFrame) -> DataFrame:
    return staging.select(F.col("department").alias("department_name")).distinct().withColumns({
        "department_head": F.lit(TO_BE_DEFINED), "cost_center": F.lit(TO_BE_DEFINED)})


def job_role_source(staging: DataFrame) -> DataFrame:
    return staging.select(F.col("job_role").alias("job_title")).distinct().withColumns({
        "job_level": F.lit(JOB_LEVEL), "job_family": F.lit(JOB_FAMILY)})


def location_source(staging: DataFrame) -> DataFrame:
    # The texts repeat far more than they differ, so they are made distinct before
    # the parse; two texts can still give one place.
    texts = staging.select("location").distinct()
    parts = place_parts(F.col("location"))
    places = texts.select(*[c.alias(n) for n, c in parts.items()]).distinct()
    return places.withColumn("region", F.lit(UNKNOWN))


def employee_source(staging: DataFrame, as_of: dt.date) -> DataFrame:
    """Employee attributes of every staging row; equal rows are still to be made one."""
    return staging.select(
        "employee_id", F.col("name").alias("full_name"), "gender", "ethnicity", "age_group", "hire_date",
        F.when(F.col("attrition") == 1, F.lit(as_of)).alias("termination_date"), "salary_band",
        F.col("promotion_date").isNotNull().cast("int").alias("promotion_recent"))


def new_dates(existing: DataFrame, staging: DataFrame) -> DataFrame:
    """Calendar rows for hire dates that the date dimension does not hold yet."""
    rows = calendar_rows(staging, "hire_date")
    return rows.join(existing.select("date_key"), "date_key", "left_anti").select(*DIMENSIONS["date"])


# Each dimension's lookup: staging columns to join on, and what a miss is called.
LOOKUPS = {
    "employee": ("employee_id",),
    "department": ("department_name",),
    "job_role": ("job_title", "job_level"),
    "location": ("city", "state", "country"),
    "date": ("date_key",),
}

# What the fact or a reject report needs; other staging columns are not written again.
RESOLVED_FROM_STAGING = (
    "employee_id", "department", "job_role", "location", "hire_date", "attrition", "tenure_months",
    "satisfaction_score", "attrition_probability", "salary", "overtime_hours",
)


def resolve_keys(staging: DataFrame, dimensions: dict[str, DataFrame],
                 collation: str | None = None, employees: int = 0) -> DataFrame:
    """Staging rows with the five dimension keys and ``reject_reasons`` (the dimensions missed).

    One pass of left joins; rows with an empty reason list are facts. With a
    ``collation`` such as ``UTF8_LCASE`` the text keys match by it. ``employees`` is the
    number of rows of the employee dimension, if known: a large one is shuffled.
    """
    place = place_parts(F.col("location"))
    keyed = staging.withColumns({
        "department_name": F.col("department"), "job_title": F.col("job_role"),
        "job_level": F.lit(JOB_LEVEL), **place, "date_key": date_key(F.col("hire_date"))})
    for name, on in LOOKUPS.items():
        key = KEY_OF[name]
        lookup = dimensions[name].select(*dict.fromkeys([*on, key]))
        if collation:
            text = [c for c in on if dict(lookup.dtypes)[c] == "string"]
            keyed = keyed.withColumns({c: F.collate(c, collation) for c in text})
            lookup = lookup.withColumns({c: F.collate(c, collation) for c in text})
        found = f"_has_{name}"
        keyed = keyed.join(beside(lookup.withColumn(found, F.lit(True)), employees if name == "employee" else 0), list(on), "left")
    misses = F.filter(F.array(*[F.when(F.col(f"_has_{n}").isNull(), F.lit(n)) for n in LOOKUPS]),
                      lambda r: r.isNotNull())
    return keyed.withColumn("reject_reasons", misses).select(
        *[KEY_OF[n] for n in LOOKUPS], *RESOLVED_FROM_STAGING, "reject_reasons")


def fact_source(resolved: DataFrame) -> DataFrame:
    """Fact columns (without ``metric_id``) of the rows that met every dimension."""
    accepted = resolved.where(F.size("reject_reasons") == 0)
    renamed = {"attrition_flag": F.col("attrition"), "headcount": F.lit(HEADCOUNT)}
    return accepted.select(*[
        renamed.get(c, F.col(c)).cast(kind).alias(c) for c, kind in FACT.items() if c != "metric_id"
    ]).withColumn(PARTITION, F.expr("date_key div 10000").cast("int"))


def rejected_rows(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.size("reject_reasons") > 0)
