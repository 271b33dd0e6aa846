"""One output shape for both sides: ``"name:kind ..."`` with kinds i, d and s."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def columns(shape: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in shape.split()]


def shaped(df: DataFrame, shape: str) -> DataFrame:
    """Whole numbers as bigint, other numbers as double with six places, the rest as text."""
    chosen = []
    for name, kind in columns(shape):
        value = F.col(f"`{name}`")
        if kind == "i":
            value = value.cast("bigint")
        elif kind == "d":
            value = F.round(value.cast("double"), 6) + F.lit(0.0)
        else:
            value = value.cast("string")
        chosen.append(value.alias(name))
    return df.select(*chosen)


def shaped_sql(sql: str, shape: str) -> str:
    chosen = []
    for name, kind in columns(shape):
        quoted = f'"{name}"'
        if kind == "i":
            chosen.append(f"CAST({quoted} AS BIGINT) AS {quoted}")
        elif kind == "d":
            chosen.append(f"round(CAST({quoted} AS DOUBLE), 6) + 0.0 AS {quoted}")
        else:
            chosen.append(f"CAST({quoted} AS VARCHAR) AS {quoted}")
    return f"SELECT {', '.join(chosen)} FROM ({sql})"
