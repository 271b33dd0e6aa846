"""Total orders without a one-task window: positions, surrogate keys, quantiles."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermart.sources import scratch

_MARK = "_slice_row"
# monotonically_increasing_id() keeps the task in the upper bits and the row
# number inside the task in the lower 33.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def _sliced(df: DataFrame, order: Sequence[str | Column], label: str) -> DataFrame:
    """Rows written in range slices of ``order``, each marked with slice and row number."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    table = scratch.saved(ranged.withColumn(_MARK, F.monotonically_increasing_id()), label)
    return table.withColumn("_slice", F.shiftright(_MARK, _ROW_BITS)).withColumn(
        "_row", F.col(_MARK).bitwiseAND(F.lit(_ROW_MASK))
    ).drop(_MARK)


def positions(df: DataFrame, order: Sequence[str | Column], name: str = "position",
              first: int = 0) -> DataFrame:
    """Add the place of every row in the total order ``order``, counting from ``first``.

    Rows are range-partitioned and numbered inside their slice; one row count
    per slice goes to the driver (as many as there are tasks, never rows) and
    comes back as the start of each slice. Ties need a tie-break in ``order``.
    """
    spark = df.sparkSession
    table = _sliced(df, order, "positions")
    sizes = table.groupBy("_slice").agg(F.count("*").alias("n")).orderBy("_slice").collect()
    starts, total = [], first
    for size in sizes:
        starts.append((size["_slice"], total))
        total += size["n"]
    offsets = spark.createDataFrame(starts, "_slice long, _start long")
    placed = table.join(F.broadcast(offsets), "_slice")
    return placed.withColumn(name, F.col("_start") + F.col("_row")).drop("_slice", "_row", "_start")


def dense_ids(df: DataFrame, order: Sequence[str | Column], name: str,
              high_water: int = 0) -> DataFrame:
    """Surrogate keys ``high_water + 1, ...`` in natural-key order."""
    keyed = positions(df, order, name, first=high_water + 1)
    return keyed.select(name, *df.columns)


def quantiles(df: DataFrame, column: str, probabilities: Sequence[float],
              approximate: bool = False) -> list[float | None]:
    """Quantiles of a numeric column with linear interpolation between neighbours.

    The exact form counts distinct values first, so that a frequent value costs
    one row, and then opens only the range slices that hold a wanted rank.
    """
    if approximate:
        found = df.agg(F.percentile_approx(column, list(probabilities), 10000).alias("q")).first()["q"]
        return [None if v is None else float(v) for v in found or [None] * len(probabilities)]
    counted = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v"))
               .agg(F.count("*").alias("n")))
    table = _sliced(counted, ["v"], "quantiles")
    sizes = table.groupBy("_slice").agg(F.sum("n").alias("n")).orderBy("_slice").collect()
    total = sum(s["n"] for s in sizes)
    if total == 0:
        return [None] * len(probabilities)
    spots = [(total - 1) * p for p in probabilities]
    ranks = sorted({r for s in spots for r in (math.floor(s), math.ceil(s))})
    start, opened, starts = 0, [], []
    for size in sizes:
        if any(start <= r < start + size["n"] for r in ranks):
            opened.append(size["_slice"])
            starts.append((size["_slice"], start))
        start += size["n"]
    offsets = df.sparkSession.createDataFrame(starts, "_slice long, _start long")
    upto = Window.partitionBy("_slice").orderBy("_row")
    running = (table.where(F.col("_slice").isin(opened)).join(F.broadcast(offsets), "_slice")
               .withColumn("last", F.col("_start") + F.sum("n").over(upto) - 1)
               .withColumn("head", F.col("last") - F.col("n") + 1))
    wanted = F.array(*[F.lit(r).cast("long") for r in ranks])
    hits = running.select("v", F.explode(F.filter(
        wanted, lambda r: (r >= F.col("head")) & (r <= F.col("last")))).alias("rank")).collect()
    value = {h["rank"]: float(h["v"]) for h in hits}
    return [value[math.floor(s)] + (value[math.ceil(s)] - value[math.floor(s)]) * (s - math.floor(s))
            for s in spots]
