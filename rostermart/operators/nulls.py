"""Null handling in required columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermart.functions.naming import snake_case

# The strategies, and the columns that hold numbers.
NUMERIC_COLUMNS = ("age", "salary", "satisfaction_score", "overtime_hours")
NUMBER_TEXTS = (*NUMERIC_COLUMNS, "attrition")
NULL_STRATEGIES = ("drop", "fill_default")


class MissingColumnsError(ValueError):
    """A required column is not in the input."""

    def __init__(self, missing: Sequence[str]):
        self.missing_columns = list(missing)
        super().__init__("Missing required columns: " + ", ".join(missing))


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise with the sorted names of all absent columns; looks at the schema only."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumnsError(missing)


def _absent(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _present_in(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def null_rows(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """The rows with a null in a required column, with the list of those columns."""
    names = _present_in(df, required)
    gaps = F.filter(F.array(*[F.when(_absent(df, c), F.lit(c)) for c in names]),
                    lambda name: name.isNotNull())
    found = reduce(Column.__or__, [_absent(df, c) for c in names], F.lit(False))
    return df.where(found).withColumn("null_columns", gaps)


def null_counts(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Nulls per required column, all in one aggregate: ``(column_name, null_rows)``."""
    names = _present_in(df, required)
    counts = df.agg(*[F.count_if(_absent(df, c)).alias(f"n{i}") for i, c in enumerate(names)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_rows"))
        for i, c in enumerate(names)
    ])))


def treat_nulls(df: DataFrame, strategy: str, required: Iterable[str],
                number_texts: Iterable[str] = NUMBER_TEXTS) -> DataFrame:
    """Drop rows with a null in a required column, or fill with ``""`` and ``0``.

    ``number_texts`` names (in snake case) the columns that hold numbers even
    while they are text, as after reading a CSV; these get ``"0"``.
    """
    if strategy not in NULL_STRATEGIES:
        raise ValueError(f"Unknown null strategy: {strategy}")
    names = _present_in(df, required)
    if strategy == "drop":
        return df.na.drop("any", subset=names)
    defaults: dict[str, str | int] = {}
    for c in names:
        kind = df.schema[c].dataType
        if isinstance(kind, T.StringType):
            defaults[c] = "0" if snake_case(c) in number_texts else ""
        elif isinstance(kind, T.NumericType):
            defaults[c] = 0
    return df.na.fill(defaults) if defaults else df
