import math

import numpy as np
import pytest

from rostermart.llm import whitening as w

KIND = "vec_id long, embedding array<float>, n int, component string"


def brute(rows):
    """Distinct integer vectors, their covariance in exact sums, and numpy's eigenvectors."""
    ids, xs = [], []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            ids.append(i)
            xs.append([math.floor(64 * float(np.float32(c))) + 1000000 for c in v])
    fit = np.array(sorted(set(map(tuple, xs))), object)
    n, s = len(fit), fit.sum(0)
    centred = np.array((fit * n - s) / n, float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return ids, np.array(xs, object), n, s, values[::-1], vectors[:, ::-1]


def test_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(3)
    spread = rng.standard_normal((24, 24)) * np.linspace(2, 0.2, 24)
    rows = [(i, (rng.standard_normal(24) @ spread).tolist()) for i in range(700)]
    rows += [(i, rows[5][1]) for i in range(700, 1000)] + [(5, rows[5][1]), (None, rows[6][1])]
    bad = [(2000, None), (2001, []), (2002, [None] + [0.0] * 23), (2003, [math.nan] * 24), (2004, [-math.inf] + [1.0] * 23), (2005, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 7, "x") for i, v in rows + bad], KIND).repartition(5)
    got = w.whitened(table).toPandas()
    ids, xs, n, s, values, vectors = brute(rows)
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n} and n == 700
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    first = got[got["component"] == 1]
    assert sorted(first["deviation"]) == sorted(int(((n * x - s) ** 2).sum()) for x in xs)
    for component in range(1, 17):
        mine = got[(got["component"] == component) & got["vec_id"].notna()].drop_duplicates("vec_id").sort_values("vec_id")
        plain = {i: float(np.array((n * x - s) / n, float) @ vectors[:, component - 1]) / math.sqrt(values[component - 1])
                 for i, x in zip(ids, xs, strict=True) if i is not None}
        want = np.array([plain[i] for i in mine["vec_id"]])
        have = mine["whitened"].to_numpy()
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-8
        assert np.allclose(mine["explained"], values[component - 1] / values.sum(), rtol=1e-10)


def test_little_that_varies(spark):
    def one(rows):
        return w.whitened(spark.createDataFrame([(i, v, 1, "") for i, v in rows], KIND)).collect()

    assert one([]) == [] and one([(1, None)]) == [] and one([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    flat = one([(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])])
    assert [r.component for r in flat] == [1, 1, 1] and all(abs(r.explained - 1) < 1e-12 for r in flat)
    narrow = one([(i, [float(i % 3), float(i % 5), float(i * i % 7)]) for i in range(50)])
    assert {r.component for r in narrow} == {1, 2, 3} and narrow[0].identity_error < 1e-10


def test_entries_beyond_the_limit_are_errors(spark):
    with pytest.raises(Exception, match="too large"):
        w.whitened(spark.createDataFrame([(1, [1e30], 1, ""), (2, [0.0], 1, "")], KIND)).collect()


def test_deviation_stays_exact_or_fails():
    rng = np.random.default_rng(0)
    x = rng.integers(-10 ** 9, 10 ** 9, (20, 3))
    centre = w.Centre(20, [int(v) for v in x.sum(0)])
    want = [sum((20 * int(a) - s) ** 2 for a, s in zip(r, centre.sums, strict=True)) for r in x]
    if max(want) < 1 << 63:
        assert centre.deviation(x).tolist() == want
    small = w.Centre(10 ** 6, [0, 0, 0])
    with pytest.raises(OverflowError):
        small.deviation(x)


@pytest.mark.parametrize(("d", "k"), [(200, 16), (90, 5), (16, 16), (7, 16)])
def test_pairs_reach_double_precision(d, k):
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = np.sort(np.concatenate([[50.0, 50.0 - 1e-6][:min(2, d)], rng.uniform(1, 9, d - 2)]))[::-1]
    matrix = (turn * values) @ turn.T
    found, vectors, residuals = w.jacobi_davidson(lambda b: matrix @ b, d, k)
    assert np.allclose(found, values[:min(k, d)], rtol=1e-13)
    assert residuals.max() < 1e-11 and np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)


def test_inner_solver_reduces_the_residual():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    right = rng.standard_normal((30, 4))
    got = w._lanczos_solve(lambda z: a @ z, right, 40)
    assert np.abs(a @ got - right).max() < 1e-6
