"""Constraint checks as Spark jobs."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermart.schemas import Constraints

SMALL_DATA = 100


class EmptyInputError(ValueError):
    """There is nothing to load."""


class CountMismatchError(RuntimeError):
    """The written table does not hold the rows that were sent."""


def _overflows(df: DataFrame, column: str, precision: int, scale: int) -> Column:
    """Whether the value rounded to ``scale`` needs more than ``precision`` digits.

    Numbers are compared with the first value that rounds out of range, which
    spares a conversion per row.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.col(column).isNotNull() & F.col(column).try_cast(f"decimal({precision},{scale})").isNull()
    limit = Decimal(10) ** (precision - scale) - Decimal(5).scaleb(-scale - 1)
    edge = F.lit(float(limit)) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.lit(limit)
    return F.abs(F.col(column)) >= edge


def broken_rules(df: DataFrame, rules: Constraints) -> dict[str, Column]:
    """A condition per rule that is true where the row breaks it."""
    broken: dict[str, Column] = {}
    for c in rules.required:
        if c in df.columns:
            broken[f"not_null:{c}"] = F.col(c).isNull()
    for c, longest in rules.max_length.items():
        if c in df.columns:
            broken[f"max_length:{c}"] = F.length(F.col(c).cast("string")) > longest
    for c, (precision, scale) in rules.decimals.items():
        if c in df.columns:
            broken[f"decimal:{c}"] = _overflows(df, c, precision, scale)
    for c, (low, high) in rules.between.items():
        if c in df.columns:
            broken[f"between:{c}"] = ~F.col(c).between(low, high)
    return broken


def check_rules(df: DataFrame, rules: Constraints | Mapping[str, Column]) -> DataFrame:
    """``(rule, violations)`` for all row rules, in one aggregate over one scan."""
    broken = broken_rules(df, rules) if isinstance(rules, Constraints) else dict(rules)
    names = list(broken)
    counts = df.agg(*[F.count_if(broken[n]).alias(f"v{i}") for i, n in enumerate(names)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("violations"))
        for i, n in enumerate(names)])))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose non-null reference has no parent.

    References are counted per value before the join, so a hot value is one row there.
    """
    used = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return used.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def check_star(star) -> DataFrame:
    """``(rule, violations)`` over all tables of a star: rows, unique keys and references."""
    from rostermart.schemas import DIMENSION_RULES, FACT_RULES, KEY_OF

    found = []
    tables = {f"dim_{n}": (star.dimension(n), r) for n, r in DIMENSION_RULES.items()}
    tables["fact"] = (star.fact, FACT_RULES)
    for name, (table, rules) in tables.items():
        found.append(check_rules(table, rules).select(
            F.concat(F.lit(f"{name}:"), "rule").alias("rule"), "violations"))
        for keys in rules.unique:
            found.append(repeated_keys(table, keys).agg(F.count("*").alias("violations")).select(
                F.lit(f"{name}:unique:{'+'.join(keys)}").alias("rule"), "violations"))
    # All references in one scan: the fact's distinct keys, one column below the other.
    def named(column):
        return F.struct(F.lit(column).alias("key"), F.col(column).cast("long").alias("value"))

    used = (star.fact.select(F.explode(F.array(*[named(k) for k in KEY_OF.values()])).alias("k")).select("k.*")
            .where("value IS NOT NULL").groupBy("key", "value").agg(F.count("*").alias("rows")))
    parents = reduce(DataFrame.unionByName, [star.dimension(d).select(named(k).alias("k")).select("k.*") for d, k in KEY_OF.items()])
    lost = used.join(parents, ["key", "value"], "left_anti").groupBy("key").agg(F.sum("rows").alias("violations"))
    keys = star.fact.sparkSession.createDataFrame([(k,) for k in KEY_OF.values()], "key string")
    found.append(keys.join(lost, "key", "left").select(
        F.concat(F.lit("fact:foreign_key:"), "key").alias("rule"), F.coalesce("violations", F.lit(0)).alias("violations")))
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise EmptyInputError(f"No rows in {what}; the load is given up")


def require_same_count(sent: int, stored: int, what: str) -> None:
    if sent != stored:
        raise CountMismatchError(f"{what}: {sent} rows sent, {stored} stored")


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class, 0 and 1, from one aggregate of fixed size.

    Raises if the label is null or anything else in some row, or if a class has
    fewer than two rows; warns below 100 rows. A class without rows is left out.
    """
    value = F.col(label)
    found = df.agg(F.count_if(value == 0).alias("no"), F.count_if(value == 1).alias("yes"), F.count("*").alias("rows")).first()
    total = found["rows"]
    if found["no"] + found["yes"] < total:
        raise ValueError(f"{label} is neither 0 nor 1 in {total - found['no'] - found['yes']} rows")
    counts = {c: n for c, n in ((0, found["no"]), (1, found["yes"])) if n}
    if total < SMALL_DATA:
        warnings.warn(f"Only {total} rows: a model on fewer than {SMALL_DATA} records may be "
                      "unreliable", UserWarning, stacklevel=3)
    if any(n < 2 for n in counts.values()):
        raise ValueError("Every class needs at least two rows to be split")
    return counts


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill nulls of the named columns, or add the column, with a default value."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v)
        for c, v in defaults.items()})
