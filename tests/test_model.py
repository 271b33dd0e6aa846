import math
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostermart.config import ModelSpec
from rostermart.operators.quality import class_counts
from rostermart.plans import model as ml
from rostermart.sources import scratch

PARAMS = {"logistic_regression": {"max_iter": 1000, "solver": "lbfgs", "C": 1.0},
          "random_forest": {"n_estimators": 10, "max_depth": 5, "min_samples_split": 2, "min_samples_leaf": 2}}
SPEC = ModelSpec(("logistic_regression", "random_forest"), 0.2, 42, PARAMS)


def frame(spark, n, seed=5):
    """Leaving depends on load and, less, on the way to work; pay and team size say nothing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        load, commute = rng.uniform(-3, 3), rng.expovariate(1.0)
        leaves = rng.random() < 1 / (1 + math.exp(-1.8 * load - 0.7 * (commute - 1)))
        rows.append((i, load, rng.triangular(-400, 900), rng.choice([3, 5, 8, 13]), commute, int(leaves)))
    return scratch.saved(spark.createDataFrame(
        rows, "employee_id long, shift_load double, pay_gap double, team_size int, commute double, attrition int"),
        "frame")


@pytest.fixture(scope="module")
def trained(spark):
    df = frame(spark, 400)
    return df, ml.train(df, SPEC)


def test_comparison(trained):
    _, result = trained
    rows = result.comparison.orderBy("place").collect()
    assert {r["model_name"] for r in rows} == set(SPEC.algorithms)
    assert [r["auc_roc"] for r in rows] == sorted((r["auc_roc"] for r in rows), reverse=True)
    assert rows[0]["model_name"] == result.best_name
    assert set(result.models) == set(SPEC.algorithms)
    for found in result.metrics.values():
        assert set(found) == set(ml.METRICS)
        assert all(0.0 <= v <= 1.0 for v in found.values())


def test_what_decides_the_label_is_found(trained):
    _, result = trained
    assert result.comparison.agg(F.min("auc_roc")).first()[0] > 0.8
    first = result.importances.orderBy(F.col("importance").desc()).first()
    assert first["feature"] == "shift_load"


def test_unknown_settings_and_depths_are_errors():
    for algorithm, params in (("logistic_regression", {"class_weight": "balanced"}), ("logistic_regression", {"penalty": "l3"}),
                              ("random_forest", {"max_depth": None}), ("random_forest", {"max_depth": 31}), ("boosting", {})):
        with pytest.raises(ValueError):
            ml.estimator(algorithm, params, 1, 100)


def test_importances(trained, spark):
    _, result = trained
    for name, model in result.models.items():
        rows = ml.feature_importance(model, result.features, spark).collect()
        assert {r["feature"] for r in rows} == {"shift_load", "pay_gap", "team_size", "commute"}
        weights = [r["importance"] for r in rows]
        assert weights == sorted(weights, reverse=True)
        if name == "random_forest":
            assert sum(weights) == pytest.approx(1.0)


def test_identity_columns_are_features_on_request(trained):
    df, result = trained
    assert "employee_id" not in result.features
    assert ml.feature_columns(df, identity=()) == ["employee_id", *result.features]


def test_same_seed_same_result(trained):
    df, result = trained
    again = ml.train(df.repartition(3), SPEC)
    for name, found in result.metrics.items():
        assert again.metrics[name] == pytest.approx(found, abs=1e-9)


def test_small_data_warning(spark):
    with pytest.warns(UserWarning, match="fewer than 100 records"):
        ml.train(frame(spark, 60), ModelSpec(("logistic_regression",), 0.2, 42, PARAMS))


def test_unsupported(spark):
    df = frame(spark, 120)
    with pytest.raises(ValueError, match="Unsupported algorithm"):
        ml.train(df, ModelSpec(("gradient_magic",)))
    with pytest.raises(ValueError, match="solver"):
        ml.estimator("logistic_regression", {"solver": "saga"}, 1, 10)
    with pytest.raises(ValueError, match="at least two rows"):
        ml.train(df.where("employee_id < 110 and attrition = 0").unionByName(
            df.where("attrition = 1").limit(1)), SPEC)
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        ml.estimator("random_forest", {"min_samples_split": 5}, 1, 10)
    assert "min_samples_split" in str(seen[0].message)


def test_a_label_of_many_values_is_counted_and_not_collected(spark):
    df = spark.range(300).selectExpr("id", "cast(id as int) as attrition", "nullif(id % 3, 2) as gaps", "id % 2 as fine", "1 as ones")
    with pytest.raises(ValueError, match="attrition is neither 0 nor 1 in 298 rows"):
        class_counts(df, "attrition")
    with pytest.raises(ValueError, match="gaps is neither 0 nor 1 in 100 rows"):
        class_counts(df, "gaps")
    assert class_counts(df, "fine") == {0: 150, 1: 150}
    assert class_counts(df, "ones") == {1: 300}


def test_split_is_stable_and_stratified(spark):
    df = frame(spark, 5000)
    train, test = ml.stratified_split(df, "attrition", 0.2, 7, ["employee_id"])
    other = ml.stratified_split(df.repartition(13), "attrition", 0.2, 7, ["employee_id"])[1]
    assert train.count() + test.count() == 5000
    assert sorted(test.collect()) == sorted(other.collect())
    shares = df.join(test.select("employee_id", F.lit(1).alias("t")), "employee_id", "left").groupBy(
        "attrition").agg(F.avg(F.coalesce("t", F.lit(0))).alias("s")).collect()
    assert all(abs(r["s"] - 0.2) < 0.03 for r in shares)
    exact = ml.stratified_split(df, "attrition", 0.2, 7, ["employee_id"], exact=True)
    for label in (0, 1):
        whole = df.where(F.col("attrition") == label).count()
        assert abs(exact[1].where(F.col("attrition") == label).count() - 0.2 * whole) <= 1.5


def test_penalty_equals_the_summed_objective(spark):
    """Coefficients against Newton steps on sum of log losses + |w|^2 / (2 C)."""
    df = frame(spark, 600).select("employee_id", "shift_load", "commute", "attrition")
    c = 0.05
    result = ml.train(df, ModelSpec(("logistic_regression",), 0.2, 42, {
        "logistic_regression": {"C": c, "max_iter": 500, "tol": 1e-12}}))
    rows = np.array(ml.stratified_split(df, "attrition", 0.2, 42, ["employee_id"], exact=True)[0].drop("employee_id").collect(),
                    dtype=float)
    x, y = np.c_[np.ones(len(rows)), rows[:, :2]], rows[:, 2]
    w, ridge = np.zeros(3), np.diag([0.0, 1 / c, 1 / c])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    fitted = result.models["logistic_regression"].stages[-1]
    assert fitted.coefficients.toArray() == pytest.approx(w[1:], abs=1e-5)
    assert fitted.intercept == pytest.approx(w[0], abs=1e-5)


def test_metrics_of_the_positive_class(spark):
    df = spark.createDataFrame([(1, 1.0)] * 3 + [(0, 1.0)] + [(1, 0.0)] * 2 + [(0, 0.0)] * 4, "attrition int, prediction double")
    row = ml.class_metrics(ml.confusion(df)).first()
    assert tuple(row) == (0.7, 0.75, 0.6, pytest.approx(2 / 3))
    none = ml.class_metrics(ml.confusion(df.withColumn("prediction", F.lit(0.0)))).first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_auc_counts_ties_as_half(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(2), float(rng.randrange(5))) for _ in range(200)]
    pairs = [(a, b) for y, a in rows if y for z, b in rows if not z]
    wanted = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    assert ml.exact_auc(spark.createDataFrame(rows, "attrition int, s double"), "s") == pytest.approx(wanted)


def test_score_and_artifact(trained, tmp_path):
    df, result = trained
    path = str(tmp_path / "model")
    ml.save_model(result.models[result.best_name], path)
    scored = ml.score(ml.load_model(path), df.drop("attrition"))
    assert scored.columns == [*df.drop("attrition").columns, "attrition_probability"]
    assert scored.count() == df.count()
    assert scored.where("attrition_probability between 0 and 1").count() == df.count()
    assert "attrition" in ml.score(result.models[result.best_name], df).columns
