"""Text columns to numbers."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermart.config import FeatureSpec
from rostermart.functions.derive import bucket_code
from rostermart.operators.ordering import positions
from rostermart.sources import scratch

log = logging.getLogger(__name__)

CODE = "_code_"
#: Columns of so many values at most carry their values as names of a vector's places.
NAMED_VALUES = 1000
#: Metadata of a vector whose places are called by their numbers: how many there are.
NUMBERED = "numbered_places"
VECTORS = "_vectors_"


def text_columns(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in but]


def bucket_columns(specs: Sequence[FeatureSpec]) -> dict[str, list[str]]:
    """Label lists of the bucket features; these get bin codes instead of encodings."""
    return {s.name: list(s.params["labels"]) for s in specs if s.logic == "bucket"}


def _melted(df: DataFrame, columns: Sequence[str], keep: Sequence[Column] = ()) -> DataFrame:
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("slot"), F.col(c).alias("value")) for i, c in enumerate(columns)]))
    return (df.select(*keep, cells.alias("cell")).select("*", "cell.slot", "cell.value").drop("cell")
            .where(F.col("value").isNotNull()))


def label_codes(df: DataFrame, columns: Sequence[str], order: Sequence[Column]) -> dict[str, DataFrame]:
    """Code table ``(value, code)`` per column: codes count values by first appearance in ``order``.

    All columns share one aggregate and one distributed numbering. Each code
    table is written to its own folder, so its file size is known to the joins.
    """
    keys = [o.alias(f"k{i}") for i, o in enumerate(order)]
    melted = _melted(df, columns, keys)
    seen = melted.groupBy("slot", "value").agg(
        F.min(F.struct(*[F.col(f"k{i}") for i in range(len(order))])).alias("first"))
    return _code_tables(positions(seen, ["slot", "first", "value"]), columns)[0]


def category_index(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, DataFrame], list[int]]:
    """Code table ``(value, code)`` per column, codes in value order, and the number of values of each.

    Values are numbered where they lie; only their numbers per column reach the driver.
    """
    return _code_tables(positions(_melted(df, columns).distinct(), ["slot", "value"]), columns)


def _code_tables(placed: DataFrame, columns: Sequence[str]) -> tuple[dict[str, DataFrame], list[int]]:
    spark = placed.sparkSession
    found = {r["slot"]: (r["start"], r["n"])
             for r in placed.groupBy("slot").agg(F.min("position").alias("start"), F.count("*").alias("n")).collect()}
    path = scratch.new_path(spark, "codes")
    start = F.coalesce(*[F.when(F.col("slot") == s, F.lit(first)) for s, (first, _) in found.items()], F.lit(0))
    (placed.select("slot", "value", (F.col("position") - start).alias("code"))
     .write.partitionBy("slot").parquet(path))
    tables = {c: spark.read.schema("value string, code long").parquet(f"{path}/slot={i}")
              if i in found else spark.createDataFrame([], "value string, code long")
              for i, c in enumerate(columns)}
    return tables, [found.get(i, (0, 0))[1] for i in range(len(columns))]


def label_encode(df: DataFrame, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Replace each text by its code, null by -1."""
    for column, codes in label_codes(df, columns, order).items():
        named = codes.select(F.col("value").alias(column), F.col("code").alias("_code"))
        df = df.join(named, column, "left").withColumn(
            column, F.coalesce("_code", F.lit(-1).cast("long"))).drop("_code").select(*df.columns)
    return df


def onehot_encode(df: DataFrame, columns: Sequence[str], max_categories: int | None = None) -> DataFrame:
    """Replace each text column by 0/1 columns ``<column>_<value>`` in value order.

    A null row is all zeros. Every value becomes a column, which the caller may
    bound: more than ``max_categories`` values are an error then, and
    ``onehot_vector`` takes any number.
    """
    values = scratch.saved(_melted(df, columns).distinct(), "categories")
    sizes = {r["slot"]: r["count"] for r in values.groupBy("slot").count().collect()}
    wide = [columns[s] for s, n in sorted(sizes.items()) if max_categories is not None and n > max_categories]
    if wide:
        raise ValueError(f"More than {max_categories} categories in: " + ", ".join(wide))
    found = sorted((r["slot"], r["value"]) for r in values.collect())
    flags = [F.coalesce(F.col(columns[s]) == v, F.lit(False)).cast("int").alias(f"{columns[s]}_{v}")
             for s, v in found]
    return df.select(*[F.col(c) for c in df.columns if c not in columns], *flags)


def onehot_vector(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each text column by one sparse vector ``<column>_vec`` with a place per value, in value order; null is all zeros.

    Any number of values: the index is a table that is joined, and a vector holds one number.
    The places of a column of up to NAMED_VALUES values carry these as names. A column without
    values gives vectors of one place.
    """
    codes, sizes = category_index(df, columns)
    rows, vectors, described = df, {}, {}
    for column, size in zip(columns, sizes, strict=True):
        index, width = f"{column}_idx", max(size, 1)
        known: dict = {"num_attrs": width}
        if 0 < size <= NAMED_VALUES:
            values = [r["value"] for r in codes[column].orderBy("code").collect()]
            known["attrs"] = {"binary": [{"idx": i, "name": v} for i, v in enumerate(values)]}
        named = codes[column].select(F.col("value").alias(column), F.col("code").cast("int").alias(index))
        rows = rows.join(named, column, "left")
        hot = F.col(f"`{index}`").isNotNull()
        vectors[f"{column}_vec"] = F.struct(
            F.lit(0).alias("type"), F.lit(width).alias("size"),
            F.when(hot, F.array(f"`{index}`")).otherwise(F.array().cast("array<int>")).alias("indices"),
            F.when(hot, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
        described[f"{column}_vec"] = {"ml_attr": known} | ({} if "attrs" in known else {NUMBERED: width})
    # A vector is read from its parts: MLlib's encoder lists the name of every place on the driver.
    kind = T.StructType([T.StructField(name, VectorUDT()) for name in vectors])
    read = F.from_json(F.to_json(F.struct(*[parts.alias(name) for name, parts in vectors.items()])), kind)
    kept = [c for c in df.columns if c not in columns]
    return rows.withColumn(VECTORS, read).select(*[F.col(f"`{c}`") for c in kept], *[
        F.col(VECTORS).getField(name).alias(name, metadata=known) for name, known in described.items()])


def encode_categoricals(df: DataFrame, strategy: str, columns: Sequence[str],
                        order: Sequence[Column]) -> DataFrame:
    """``onehot`` (sparse vectors) or, for any other name, label codes."""
    if not columns:
        return df
    if strategy == "onehot":
        return onehot_vector(df, columns)
    if strategy != "label":
        log.warning("Unknown encoding %s: label codes are used", strategy)
    return label_encode(df, columns, order)


def model_columns(df: DataFrame, buckets: dict[str, list[str]], but: Sequence[str] = ()) -> list[Column]:
    """The numeric and vector columns; bucket labels as codes, null as 0, dates and texts left out.

    A column ``_code_<name>`` gives ``<name>``: that is how codes stand beside their text.
    Dots in a name, as a one-hot value may bring, become underscores, since the
    model stages would read them as nested fields.
    """
    chosen = []
    for f in df.schema.fields:
        if f.name in but:
            continue
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, VectorUDT):
            chosen.append(value.alias(f.name.removeprefix(CODE).replace(".", "_")))
        elif f.name in buckets:
            chosen.append(bucket_code(value, buckets[f.name]).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            filled = F.coalesce(value, F.lit(0).cast(f.dataType))
            chosen.append(filled.alias(f.name.removeprefix(CODE).replace(".", "_")))
    return chosen


def model_frame(df: DataFrame, buckets: dict[str, list[str]], keep: Sequence[str] = ()) -> DataFrame:
    """Only numbers, plus the ``keep`` columns as they are."""
    return df.select(*keep, *model_columns(df, buckets, keep))
