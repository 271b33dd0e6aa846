"""Tables whose files are dealt by the hash of a key, so that joins on it read them as they lie.

The files are plain parquet and any reader may take them as such. What Spark needs to
know about the deal is given to the session's catalog when a table is opened
and taken from it when the work is done; the files belong to the store, not to the catalog.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rostermart.schemas import ddl

#: Rows that a bucket is meant to have; a table of twice as many is dealt anew. One task sorts a bucket.
BUCKET_ROWS = 125_000


def bucket_count(rows: int, held: int | None = None, per_bucket: int = BUCKET_ROWS) -> int:
    """A power of two for ``rows``; a number held already stays until buckets are twice as large as meant."""
    if held and rows <= 2 * per_bucket * held:
        return held
    return 1 << max(0, -(-rows // per_bucket) - 1).bit_length()


def write(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write rows that lie by ``keys`` in ``buckets`` partitions, one file for each."""
    name = f"rostermart_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay


@contextmanager
def opened(spark: SparkSession, path: str, schema: dict[str, str], keys: Sequence[str], buckets: int) -> Iterator[DataFrame]:
    """The table below ``path`` with its deal known to Spark."""
    name = f"rostermart_{hashlib.sha256(path.encode()).hexdigest()[:16]}_{uuid.uuid4().hex[:8]}"
    clustered = ", ".join(f"`{k}`" for k in keys)
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({ddl(schema)}) USING parquet CLUSTERED BY ({clustered}) INTO {buckets} BUCKETS LOCATION '{where}'")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
