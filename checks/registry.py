"""The registered queries: a Spark function, an output shape and, where possible, SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.shape import shaped, shaped_sql

QueryFunction = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    shape: str
    run: QueryFunction
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return shaped(self.run(spark, sf_dir), self.shape)


QUERIES: dict[str, Query] = {}


def query(shape: str, sql: str | None = None) -> Callable[[QueryFunction], QueryFunction]:
    """Register the function under its own name."""

    def add(run: QueryFunction) -> QueryFunction:
        if run.__name__ in QUERIES:
            raise ValueError(f"Query registered twice: {run.__name__}")
        QUERIES[run.__name__] = Query(run.__name__, shape, run, shaped_sql(sql, shape) if sql else None)
        return run

    return add
