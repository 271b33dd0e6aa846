"""Attrition models with MLlib: split, fit, measure, choose, explain, score."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LogisticRegression, LogisticRegressionModel, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from rostermart.config import ModelSpec
from rostermart.operators.encode import NUMBERED
from rostermart.operators.ordering import quantiles
from rostermart.operators.quality import class_counts
from rostermart.sources import scratch

LABEL = "attrition"
PROBABILITY = "attrition_probability"
METRICS = ("accuracy", "precision", "recall", "f1", "auc_roc")
# Identity columns say nothing about a person's risk; pass identity=() to use them as features.
IDENTITY = ("employee_id", "name")
# The algorithms and their settings; any other name is an error.
KNOWN_PARAMS = {
    "logistic_regression": ("max_iter", "solver", "C", "tol", "penalty", "fit_intercept"),
    "random_forest": ("n_estimators", "max_depth", "min_samples_split", "min_samples_leaf", "max_features", "criterion"),
}
ALGORITHMS = tuple(KNOWN_PARAMS)
# What a feature weighs in a fitted model, by its class.
WEIGHTS = {
    LogisticRegressionModel: lambda model: [abs(float(x)) for x in model.coefficients],
    RandomForestClassificationModel: lambda model: [float(x) for x in model.featureImportances.toArray()],
}
_SPLIT_STEPS = 1_000_000


@dataclass
class TrainingResult:
    comparison: DataFrame
    best_name: str
    importances: DataFrame
    metrics: dict[str, dict[str, float]]
    models: dict[str, PipelineModel]
    features: list[str]


def split_point(key: Sequence[str], seed: int) -> Column:
    """A place from 0 up to 1 that depends only on the key and the seed."""
    hashed = F.xxhash64(*[F.col(k) for k in key], F.lit(seed))
    return F.pmod(hashed, F.lit(_SPLIT_STEPS)) / F.lit(float(_SPLIT_STEPS))


def stratified_split(df: DataFrame, label: str, test_size: float, seed: int, key: Sequence[str],
                     exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, the same under any partitioning and without a shuffle.

    Each class meets ``test_size`` in expectation. ``exact`` cuts every class at
    the quantile of its own split points, up to one row and equal points.
    """
    point = split_point(key, seed)
    if not exact:
        return df.where(point >= test_size), df.where(point < test_size)
    marked = df.withColumn("_point", point)
    cuts = {v: quantiles(marked.where(F.col(label) == v), "_point", [test_size])[0]
            for v in sorted(class_counts(df, label))}
    cut = F.coalesce(*[F.when(F.col(label) == v, F.lit(c)) for v, c in cuts.items()])
    return marked.where(F.col("_point") >= cut).drop("_point"), marked.where(F.col("_point") < cut).drop("_point")


def estimator(algorithm: str, params: Mapping[str, Any], seed: int, train_rows: int):
    """The MLlib estimator for a configured algorithm.

    The inverse penalty ``C`` counts over the sum of row losses, MLlib's over
    their mean, hence ``regParam = 1 / (C * rows)``.
    """
    if algorithm not in KNOWN_PARAMS:
        raise ValueError(f"Unsupported algorithm: {algorithm}")
    unknown = sorted(set(params) - set(KNOWN_PARAMS[algorithm]))
    if unknown:
        raise ValueError(f"Unsupported settings of {algorithm}: " + ", ".join(unknown))
    if algorithm == "logistic_regression":
        solver = params.get("solver", "lbfgs")
        if solver != "lbfgs":
            raise ValueError(f"Unsupported solver: {solver}")
        penalty = params.get("penalty", "l2")
        if penalty not in (None, "l1", "l2"):
            raise ValueError(f"Unsupported penalty: {penalty}")
        return LogisticRegression(
            labelCol=LABEL, regParam=0.0 if penalty is None else 1.0 / (float(params.get("C", 1.0)) * max(train_rows, 1)),
            elasticNetParam=1.0 if penalty == "l1" else 0.0, fitIntercept=bool(params.get("fit_intercept", True)), standardization=False, maxIter=int(params.get("max_iter", 100)),
            tol=float(params.get("tol", 1e-8)))
    depth = params.get("max_depth", 10)
    if depth is None or not 0 <= int(depth) <= 30:
        raise ValueError("max_depth has to be given, from 0 to 30: deeper trees cannot be built here")
    if params.get("min_samples_split", 2) > 2:
        warnings.warn("min_samples_split has no counterpart here and is not used; "
                      "min_samples_leaf limits the nodes", UserWarning, stacklevel=2)
    return RandomForestClassifier(
        labelCol=LABEL, numTrees=int(params.get("n_estimators", 100)), maxDepth=int(depth),
        featureSubsetStrategy=str(params.get("max_features", "sqrt") or "all"), impurity=params.get("criterion", "gini"),
        seed=seed, minInstancesPerNode=int(params.get("min_samples_leaf", 1)))


def confusion(scored: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Counts of the four outcomes in one row: ``tp, fp, fn, tn``."""
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    return scored.agg(F.count_if(yes & said).alias("tp"), F.count_if(~yes & said).alias("fp"),
                      F.count_if(yes & ~said).alias("fn"), F.count_if(~yes & ~said).alias("tn"))


def class_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; 0 where a denominator is 0."""

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def exact_auc(scored: DataFrame, score: str, label: str = LABEL) -> float:
    """Area under the ROC curve over all distinct scores (no binning)."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=0)
    return float(evaluator.evaluate(scored))


def feature_columns(df: DataFrame, identity: Sequence[str] = IDENTITY) -> list[str]:
    """All numeric and vector columns but the label and the identity columns."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (NumericType, VectorUDT)) and f.name not in (LABEL, *identity)]


def feature_names(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """A name for each place of the assembled features: ``<column>_<value>`` where a vector names its places, else ``<column>[place]``."""
    wide = [c for c in columns if isinstance(df.schema[c].dataType, VectorUDT)]
    sizes = df.select(*wide).first() if wide else {}

    def places(c: str) -> list[str]:
        named = df.schema[c].metadata.get("ml_attr", {}).get("attrs", {}).get("binary", [])
        if df.schema[c].metadata.get(NUMBERED) == sizes[c].size:
            return [f"{c.removesuffix('_vec')}_{i}" for i in range(sizes[c].size)]
        if len(named) == sizes[c].size and all("name" in a for a in named):
            return [f"{c.removesuffix('_vec')}_{a['name']}" for a in sorted(named, key=lambda a: a["idx"])]
        return [f"{c}[{i}]" for i in range(sizes[c].size)]

    return [n for c in columns for n in (places(c) if c in wide else [c])]


def feature_importance(model: PipelineModel, features: Sequence[str], spark) -> DataFrame:
    """``(position, feature, importance)``, greatest first; ties in feature order.

    Forest importances or the size of linear coefficients.
    """
    last: Model = model.stages[-1]
    weights = WEIGHTS[type(last)](last)
    rows = list(zip(range(len(features)), features, weights, strict=True))
    return spark.createDataFrame(rows, "position int, feature string, importance double").orderBy(
        F.col("importance").desc(), "position")


def training_partitions(rows: int, rows_per_partition: int = 20_000) -> int:
    """A partition count that depends on the data alone."""
    return max(1, math.ceil(rows / rows_per_partition))


def train(df: DataFrame, spec: ModelSpec, key: Sequence[str] = ("employee_id",),
          identity: Sequence[str] = IDENTITY, partitions: int | None = None,
          exact_split: bool = True) -> TrainingResult:
    """Fit and compare the configured algorithms on a numeric table with an ``attrition`` column.

    ``key`` names a row. Training rows are placed by all their values into a
    number of partitions set by the row count and sorted there, so that a
    repeat run sees the same order and a frequent key does not fill one
    partition. The best model has the greatest AUC; ties keep the configured order.
    """
    for algorithm in spec.algorithms:
        if algorithm not in ALGORITHMS:
            raise ValueError(f"Unsupported algorithm: {algorithm}")
    spark = df.sparkSession
    total = sum(class_counts(df, LABEL).values())
    key = [k for k in key if k in df.columns] or list(df.columns)
    training, test = stratified_split(df, LABEL, spec.test_size, spec.seed, key, exact_split)
    n = partitions or training_partitions(total)
    order = [*key, *[f.name for f in df.schema.fields if f.name not in key and not isinstance(f.dataType, VectorUDT)]]
    placed = training.repartition(n, *order).sortWithinPartitions(*order).persist(
        StorageLevel.MEMORY_AND_DISK)
    features = feature_columns(df, identity)
    metrics: dict[str, dict[str, float]] = {}
    models: dict[str, PipelineModel] = {}
    try:
        rows = placed.count()
        names = feature_names(placed, features)
        for algorithm in spec.algorithms:
            fitted = _without_summary(Pipeline(stages=[
                VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"),
                estimator(algorithm, spec.params.get(algorithm, {}), spec.seed, rows),
            ]).fit(placed), spark)
            scored = fitted.transform(test).select(
                LABEL, "prediction", "rawPrediction", "probability").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                found = class_metrics(confusion(scored)).first().asDict()
                found["auc_roc"] = exact_auc(scored.select(LABEL, "rawPrediction"), "rawPrediction")
            finally:
                scored.unpersist()
            metrics[algorithm], models[algorithm] = found, fitted
    finally:
        placed.unpersist()
    ranked = sorted(spec.algorithms, key=lambda a: -metrics[a]["auc_roc"])
    comparison = spark.createDataFrame(
        [(i, a, *[metrics[a][m] for m in METRICS]) for i, a in enumerate(ranked)],
        "place int, model_name string, " + ", ".join(f"{m} double" for m in METRICS))
    best = ranked[0]
    return TrainingResult(comparison, best, feature_importance(models[best], names, spark),
                          metrics, models, features)


def _without_summary(model: PipelineModel, spark) -> PipelineModel:
    """The model without its training summary, by way of its artifact.

    The summary of a freshly fitted linear model holds the session, which
    cannot be sent to tasks once the session has observed a job.
    """
    if not getattr(model.stages[-1], "hasSummary", False):
        return model
    path = scratch.new_path(spark, "fitted")
    save_model(model, path)
    return load_model(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the probability of class 1; a label column is not needed and stays if there."""
    keep = [c for c in df.columns if c != PROBABILITY]
    scored = model.transform(df.select(*keep))
    return scored.select(*keep, vector_to_array("probability")[1].alias(PROBABILITY))
