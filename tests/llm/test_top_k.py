import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostermart.llm import top_k as t

KIND = "vec_id long, embedding array<float>, v int, shard int, score string"


def brute(rows, k, every):
    vectors = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (i, q) in enumerate(vectors):
        if i % every == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for n, (j, v) in enumerate(vectors) if n != own and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(600)] + [(i, [0.5] * 8) for i in range(600, 900)] + [(900, [0.0] * 8)]
    rows += [(901, None), (902, [1.0, None] + [0.0] * 6), (950, [math.nan] + [0.0] * 7), (1000, [math.inf] + [0.0] * 7), (None, [9.0] * 8), (903, [1.0, 2.0]), (904, []), (50, [-0.25] * 8)]
    rows += [(1050, []), (1051, []), (300, [0.5] * 8), (300, [0.5] * 8)]
    table = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], KIND).repartition(5)
    for sizes in ({}, {"shard_rows": 150, "block": 4}):
        got = t.top_k(table, F.col("vec_id") % 50 == 0, **sizes).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, 5, 50)


def test_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0], 1, 1, ""), (1, [2.0], 1, 1, "")], KIND)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in t.top_k(table, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 131072)]
    assert t.top_k(table.limit(0), F.col("vec_id") == 0).count() == 0


def test_a_row_is_not_its_own_candidate_but_its_twin_is(spark):
    table = spark.createDataFrame([(50, [1.0], 1, 1, ""), (50, [1.0], 1, 1, ""), (7, [-1.0], 1, 1, "")], KIND)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in t.top_k(table, F.col("vec_id") % 50 == 0).collect())
    assert got == [(50, 1, 50, 65536)] * 2 + [(50, 2, 7, -65536)] * 2


@pytest.mark.parametrize("big", [1e30, 1e12])
def test_scores_beyond_a_long_are_errors(spark, big):
    table = spark.createDataFrame([(0, [big, big], 1, 1, ""), (1, [big, -big], 1, 1, "")], KIND)
    with pytest.raises(Exception, match="too large|not fit a long"):
        t.top_k(table, F.col("vec_id") == 0).collect()


def test_tree_skips_far_leaves():
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(c, 0.1, (200, 4)) for c in (-9, 0, 9, 30)]) * 100
    vectors = vectors.astype(np.int64)
    tree = t.BallTree(vectors)
    seen = []
    best = t._Best(3, None)
    add = best.add
    best.add = lambda s, i: (seen.append(len(i)), add(s, i))
    t.search(tree, np.arange(800)[tree.order], np.arange(800)[tree.order], np.array([5, 5, 5, 5]), -1, best)
    assert sum(seen) <= 200
    assert best.scores.tolist() == sorted((vectors @ np.array([5, 5, 5, 5])).tolist())[::-1][:3]
