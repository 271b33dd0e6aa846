"""Derived feature columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.config import FeatureSpec
from rostermart.functions.derive import LOGICS, usable_features


def derive_features(df: DataFrame, specs: Sequence[FeatureSpec], as_of: dt.date) -> DataFrame:
    """Add the configured features; a later one may use an earlier one.

    Features that depend only on what is there already go into one projection.
    """
    level: dict = {}
    for spec in usable_features(df.columns, specs):
        if spec.source in level:
            df, level = df.withColumns(level), {}
        level[spec.name] = LOGICS[spec.logic](spec, F.col(spec.source), as_of)
    return df.withColumns(level) if level else df
