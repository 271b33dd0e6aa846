"""Memory that a Python worker has freed goes back to the system when a task ends."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

Batches = Iterator[pa.RecordBatch]
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def release() -> None:
    """Allocators keep freed pages for later; workers that wait for their next task need none."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of 4 MB, unless the session has a size of its own.

    With Spark's 10,000 rows a batch was as long as a task's texts, and the buffers that an executor had sent them from
    were freed by its next garbage collection only, a hundred MB a task. Results do not depend on batches.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(4 << 20))


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function for mapInArrow that releases memory after its last batch."""
    def tidied(batches: Batches) -> Batches:
        yield from run(batches)
        release()

    return tidied
