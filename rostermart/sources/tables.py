"""Staging as a sink, and named views over results."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rostermart.operators.quality import require_same_count


def write_staging(df: DataFrame, path: str) -> int:
    """Replace the staging table; the row count comes from the same job and is read back."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite").parquet(path)
    require_same_count(seen.get["rows"], df.sparkSession.read.schema(df.schema).parquet(path).count(), path)
    return seen.get["rows"]


def write_staging_jdbc(df: DataFrame, table: str, url_variable: str = "STAGING_JDBC_URL",
                       user_variable: str = "STAGING_JDBC_USER",
                       password_variable: str = "STAGING_JDBC_PASSWORD") -> None:
    """Replace a database table, keeping its definition; the access data come from the environment."""
    options = {"url": os.environ[url_variable], "dbtable": table, "truncate": "true"}
    for option, variable in (("user", user_variable), ("password", password_variable)):
        if variable in os.environ:
            options[option] = os.environ[variable]
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
