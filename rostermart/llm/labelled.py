"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.llm.texts import held_out_expr
from rostermart.llm.tidy import tidy


def training_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int, mod: int = 5) -> tuple[DataFrame, float]:
    """At most ``per_class`` rows (doc_id, text, y) of each label that are not held out, and the share of label 1 among all such labels.

    Labels that are null or neither 0 nor 1 count for nothing; a doc_id with both
    labels counts as 0; of several texts of one doc_id the smallest by hash is
    taken. Rows are chosen by a hash of the id, so that reruns agree.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out_expr(F.col("doc_id"), mod))
             .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.where("y = 0").orderBy(*order).limit(per_class).unionByName(
        known.where("y = 1").orderBy(*order).limit(per_class))
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return (rows.groupBy("doc_id").agg(F.min_by(F.struct("text", "y"), F.xxhash64("text")).alias("r"))
            .select("doc_id", "r.text", "r.y"), share)


def fitted(sample: DataFrame, fit: Callable[[pd.DataFrame], Any]) -> Any:
    """What ``fit`` makes of the sample's rows, in the order of doc_id, in one task; the driver gets the result alone."""
    return unpacked(fitted_bytes(sample, fit))


def packed(made: Any) -> bytes:
    return zlib.compress(pickle.dumps(made, pickle.HIGHEST_PROTOCOL), 1)


def unpacked(made: bytes) -> Any:
    return pickle.loads(zlib.decompress(made))


def fitted_bytes(sample: DataFrame, fit: Callable[[pd.DataFrame], Any]) -> bytes:
    """As ``fitted``, for results that the driver only passes on: they stay packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Columns that cannot be null arrive as such, so batches take the schema before they meet; they are gone when the fit begins.
        rows = pa.Table.from_batches((b.cast(schema) for b in batches), schema).to_pandas().sort_values("doc_id", ignore_index=True)
        yield pa.RecordBatch.from_arrays([pa.array([packed(fit(rows))], pa.binary())], names=["made"])

    sample = sample.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "y")
    schema = pa.schema([("doc_id", pa.string()), ("text", pa.string()), ("y", pa.int32())])
    made = sample.coalesce(1).mapInArrow(tidy(run), "made binary").first()
    return bytes(made.made) if made else packed(fit(schema.empty_table().to_pandas()))
