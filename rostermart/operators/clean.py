"""Types, repeats and the log of what cleaning changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermart.config import FeatureSpec
from rostermart.functions.derive import usable_features
from rostermart.functions.parsing import DEFAULT_DATE_FORMATS, parse_date, parse_number
from rostermart.operators.nulls import NUMERIC_COLUMNS

LOG_SCHEMA = "column_name string, operation string, rows_affected bigint, values_imputed bigint"


@dataclass(frozen=True)
class Coercion:
    column: str
    operation: str
    value: Column


def date_texts(df: DataFrame) -> list[str]:
    """The text columns with ``date`` in their name."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and "date" in f.name]


def planned_coercions(df: DataFrame, date_columns: Sequence[str] | None = None,
                      numeric_columns: Sequence[str] = NUMERIC_COLUMNS,
                      date_formats: Sequence[str] | Mapping[str, Sequence[str]] = DEFAULT_DATE_FORMATS) -> list[Coercion]:
    """The text columns to convert: dates first, then numbers.

    By default every text column with ``date`` in its name is a date. The formats
    are those of all date columns, or a mapping has those of each. Columns that
    already have a type need no conversion and are not listed.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    dates = date_texts(df) if date_columns is None else [c for c in date_columns if c in text]
    formats = date_formats if isinstance(date_formats, Mapping) else dict.fromkeys(dates, date_formats)
    plans = [Coercion(c, "convert_to_datetime", parse_date(F.col(c), formats.get(c, DEFAULT_DATE_FORMATS)))
             for c in dates]
    plans += [Coercion(c, "convert_to_numeric", parse_number(F.col(c)))
              for c in text if c in numeric_columns and c not in dates]
    return plans


def coerce_types(df: DataFrame, **options) -> DataFrame:
    """Convert date and number columns; a value that does not fit becomes null."""
    return df.withColumns({p.column: p.value for p in planned_coercions(df, **options)})


def _entries(rows: Sequence[tuple[str, str, Column, Column]]) -> Column:
    return F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(op).alias("operation"),
                 affected.cast("bigint").alias("rows_affected"),
                 imputed.cast("bigint").alias("values_imputed"))
        for c, op, affected, imputed in rows
    ]))


def coercion_log(df: DataFrame, **options) -> DataFrame:
    """Rows seen and values lost for each converted column, in one aggregate."""
    plans = planned_coercions(df, **options)
    if not plans:
        return df.sparkSession.createDataFrame([], LOG_SCHEMA)
    counts = df.agg(F.count("*").alias("n"), *[
        F.count_if(F.col(p.column).isNotNull() & p.value.isNull()).alias(f"lost{i}")
        for i, p in enumerate(plans)])
    return counts.select(_entries([
        (p.column, p.operation, F.col("n"), F.col(f"lost{i}")) for i, p in enumerate(plans)]))


def feature_log(df: DataFrame, specs: Sequence[FeatureSpec]) -> DataFrame:
    """Rows with a value for each derived feature, in one aggregate over the derived table."""
    done = [s for s in usable_features(df.columns, specs) if s.name in df.columns]
    if not done:
        return df.sparkSession.createDataFrame([], LOG_SCHEMA)
    counts = df.agg(*[F.count(s.name).alias(f"n{i}") for i, s in enumerate(done)])
    return counts.select(_entries([
        (s.name, f"derive_feature_{s.logic}", F.col(f"n{i}"), F.lit(0)) for i, s in enumerate(done)]))


def change_log(renames: Mapping[str, str], coerced: DataFrame, rows_before: int, rows_after: int,
               features: DataFrame, encoding: str, encoded: Sequence[str]) -> DataFrame:
    """The whole log: renamed columns, conversions, removed repeats, features, encodings.

    ``coerced`` and ``features`` are the logs of those two steps; a step that
    changed nothing leaves no entry.
    """
    spark = coerced.sparkSession
    first = [("*", "standardize_column_names", len(renames), 0)] if renames else []
    repeats = rows_before - rows_after
    middle = [("*", "remove_duplicates", repeats, 0)] if repeats > 0 else []
    step = "encode_onehot" if encoding == "onehot" else "encode_label"
    last = [(c, step, rows_after, 0) for c in encoded]
    return (spark.createDataFrame(first, LOG_SCHEMA).union(coerced)
            .union(spark.createDataFrame(middle, LOG_SCHEMA)).union(features)
            .union(spark.createDataFrame(last, LOG_SCHEMA)))
