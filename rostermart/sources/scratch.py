"""Written intermediate tables in the cluster's shared folder.

Where a plan has to be cut, the rows are written as parquet and read back:
the result survives lost executors, and the file sizes tell the optimizer
whether a later join may broadcast it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # one JVM only; local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="rostermart-")
    return _local_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/rostermart/{app}/{label}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new path and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete what this application wrote with ``new_path``; results not stored elsewhere go with it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/rostermart/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
