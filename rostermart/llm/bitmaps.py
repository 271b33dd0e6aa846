"""Bitmaps of a fixed size over 64-bit keys: a filter that lets through all keys of a set, and few others.

The size does not follow the data. A set that fills the bitmap lets more rows
through to the exact join behind it and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.llm.tidy import tidy

BITS = 1 << 22


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bitmap of the only column of ``keys`` (long); at most BITS / 8 rows reach the driver."""
    slot = F.pmod(F.col(keys.columns[0]), F.lit(BITS))
    rows = (keys.select(slot.alias("slot")).selectExpr("slot div 8 AS byte", "shiftleft(1, cast(slot % 8 AS int)) AS bit")
            .groupBy("byte").agg(F.bit_or("bit").alias("bits")).toPandas())
    bits = np.zeros(BITS // 8, np.uint8)
    bits[rows["byte"].to_numpy()] = rows["bits"].to_numpy().astype(np.uint8)
    return bits


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys.view(np.int64) & np.int64(BITS - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1) == 1


def sifted(rows: DataFrame, key: str, bits: np.ndarray) -> DataFrame:
    """The rows whose ``key`` (long, never null) the bitmap lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(bits, np.asarray(batch.column(key)))))

    return rows.mapInArrow(tidy(run), rows.schema)
