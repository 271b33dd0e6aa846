"""Session settings the library is tuned for."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

# Scale with the cluster: AQE picks the partition counts, splits skewed joins and
# turns joins into broadcasts by the sizes it has seen.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "rostermart",
                  **more: str) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false"))
    for name, value in {**SETTINGS, **more}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Run a few independent actions at once, so that small ones fill the gaps of large ones."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}
