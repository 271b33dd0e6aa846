"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes all that its predecessor kept. The first four return the
columns of their input; the last returns what the mix takes of each document:
doc_id, size, source_size, target, taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostermart.llm import decontaminate, mix_sources, near_dedup, quality_net, toxic_neighbours
from rostermart.sources.scratch import saved


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples vote them toxic go."""
    return toxic_neighbours.keep_clean(docs, _table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network rejects go."""
    return quality_net.keep_good(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity of 0.8 or more."""
    return near_dedup.deduplicate(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a mix at the target weights takes of each document."""
    return mix_sources.taken(mix_sources.mix_sources(docs))


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing)]

#: SQL cannot express the classifiers' fits.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written before the next one reads them."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
