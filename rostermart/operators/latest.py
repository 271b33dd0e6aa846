"""Removing repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, key: str, latest_by: str,
                tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """The row with the greatest ``latest_by`` for each ``key``; null keys form one group.

    Ties go to the greatest ``tiebreak`` columns, by default all other columns,
    so the result does not depend on the partitioning. Spark limits each group
    to one row per map task before the shuffle, so a hot key shuffles no more
    than that. Without either column the rows pass unchanged.
    """
    if key not in df.columns or latest_by not in df.columns:
        return df
    if tiebreak is None:
        tiebreak = [F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in (key, latest_by)]
    order = Window.partitionBy(key).orderBy(F.col(latest_by).desc_nulls_last(), *tiebreak)
    return df.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def drop_repeated_rows(df: DataFrame) -> DataFrame:
    """One of each set of rows that agree in all columns."""
    return df.dropDuplicates()
