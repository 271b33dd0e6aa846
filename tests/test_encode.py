import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rostermart.config import JobSpec, ModelSpec
from rostermart.operators.encode import (
    bucket_columns, encode_categoricals, label_encode, model_frame, onehot_encode, onehot_vector)
from rostermart.operators.ordering import dense_ids, positions, quantiles
from rostermart.plans.model import feature_names, score, train
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["x", "y", "z", None]), f"n{rng.randrange(400)}") for i in range(1500)]
    return spark.createDataFrame(rows, "id long, grp string, name string").repartition(7)


def test_label_codes_follow_first_appearance(spark, people):
    local = people.toPandas().sort_values("id")
    got = label_encode(people, ["grp", "name"], [F.col("id")]).toPandas().sort_values("id")
    for c in ("grp", "name"):
        assert (got[c].to_numpy() == pd.factorize(local[c])[0]).all()
    assert list(got.columns) == ["id", "grp", "name"]


def test_label_codes_of_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None)], "id int, a string")
    assert label_encode(df, ["a"], [F.col("id")]).collect() == [(1, -1)]


def test_label_encoding_uses_no_single_partition(spark, people):
    assert "SinglePartition" not in plan_of(label_encode(people, ["grp"], [F.col("id")]))


def test_onehot(spark, people):
    local = people.toPandas().sort_values("id").reset_index(drop=True)
    wanted = pd.get_dummies(local, columns=["grp"], dtype=int)
    got = onehot_encode(people, ["grp"]).toPandas().sort_values("id").reset_index(drop=True)
    assert list(got.columns) == list(wanted.columns)
    pd.testing.assert_frame_equal(got, wanted, check_dtype=False)


def test_onehot_bound_and_vector_form(spark, people):
    with pytest.raises(ValueError, match="name"):
        onehot_encode(people, ["grp", "name"], max_categories=100)
    wide = onehot_vector(people, ["grp"])
    assert wide.columns == ["id", "name", "grp_vec"]
    for row in wide.join(people, ["id", "name"]).collect():
        hot = {"x": 0, "y": 1, "z": 2}.get(row["grp"])
        assert list(row["grp_vec"].toArray()) == [float(i == hot) for i in range(3)]


def test_onehot_vector_of_many_values(spark):
    """A value per row, a column with null last in order, and one without any value."""
    rows = spark.range(100_000).select(
        "id", F.format_string("v%06d", (F.col("id") * 7919) % 100_000).alias("wide"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), F.col("id") % 3)).alias("few"), F.lit(None).cast("string").alias("none"))
    got = onehot_vector(rows, ["wide", "few", "none"])
    assert got.columns == ["id", "wide_vec", "few_vec", "none_vec"]
    for r in got.where("id % 9973 = 0").collect():
        assert (r["wide_vec"].size, r["wide_vec"].indices.tolist()) == (100_000, [(r["id"] * 7919) % 100_000])
        assert (r["few_vec"].size, r["few_vec"].indices.tolist()) == (2, [r["id"] % 3 - 1] if r["id"] % 3 else [])
        assert (r["none_vec"].size, r["none_vec"].numNonzeros()) == (1, 0)
    assert got.count() == 100_000


def test_onehot_places_are_not_listed(spark):
    """A vector of many places carries their number and not a name for each, which would lie on the driver."""
    rows = spark.range(3000).select(F.concat(F.lit("v"), "id").alias("wide"), F.concat(F.lit("g"), F.col("id") % 2).alias("few"))
    got = onehot_vector(rows, ["wide", "few"])
    assert len(got.schema["wide_vec"].json()) < 1000
    assert feature_names(got, ["wide_vec", "few_vec"]) == [*[f"wide_{i}" for i in range(3000)], "few_g0", "few_g1"]


def test_models_take_sparse_vectors(spark):
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("employee_id"), (F.col("id") % 7).alias("age"),
        F.concat(F.lit("d"), F.col("id") % 40).alias("team"), F.when(F.col("id") % 40 < 12, 1).otherwise(0).alias("attrition"))
    spec = ModelSpec(algorithms=("logistic_regression",), params={}, test_size=0.2, seed=1)
    done = train(onehot_vector(rows, ["team"]), spec)
    assert done.metrics["logistic_regression"]["auc_roc"] > 0.99
    names = [r["feature"] for r in done.importances.collect()]
    assert len(names) == 41 and set(names) == {"age", *[f"team_d{i}" for i in range(40)]}
    assert score(done.models[done.best_name], onehot_vector(rows, ["team"])).count() == 600


def test_dispatch(spark, people, caplog):
    assert encode_categoricals(people, "onehot", ["grp"], [F.col("id")]).columns == ["id", "name", "grp_vec"]
    assert dict(encode_categoricals(people, "other", ["grp"], [F.col("id")]).dtypes)["grp"] == "bigint"
    assert "other" in caplog.text
    assert encode_categoricals(people, "label", [], []) is people


def test_model_frame(spark):
    buckets = bucket_columns(JobSpec.default().clean.features)
    df = spark.sql("select 'k1' as employee_id, date'2024-01-01' as hire_date, 'x' as name, "
                   "cast(null as double) as promotion_recency, '25-34' as age_group, "
                   "cast(null as string) as salary_band, 3 as age")
    out = model_frame(df, buckets, keep=["employee_id"])
    assert out.columns == ["employee_id", "promotion_recency", "age_group", "salary_band", "age"]
    assert out.collect() == [("k1", 0.0, 1, -1, 3)]


def test_dense_ids_equal_the_global_row_number(spark, people):
    got = dense_ids(people, ["name", "id"], "key", high_water=100)
    local = people.toPandas().sort_values(["name", "id"]).reset_index(drop=True)
    found = got.toPandas().sort_values("key").reset_index(drop=True)
    assert list(found["key"]) == list(range(101, 1601))
    assert list(found["id"]) == list(local["id"])
    assert "SinglePartition" not in plan_of(got) and "Window" not in plan_of(got)


def test_positions_do_not_depend_on_partitions(spark, people):
    results = []
    for n in (1, 64):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(tuple(r) for r in positions(people, ["id"]).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1]


def test_positions_of_nothing(spark, people):
    assert dense_ids(people.where("id < 0"), ["id"], "key").count() == 0


def test_quantiles(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=701).round(3), np.full(400, 0.125)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    assert np.allclose(quantiles(df, "v", probabilities), np.quantile(values, probabilities))
    near = quantiles(df, "v", [0.5], approximate=True)[0]
    assert abs(near - np.median(values)) < 0.05
    assert quantiles(df.where("v is null"), "v", [0.5]) == [None]
