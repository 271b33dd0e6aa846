import numpy as np
import pytest

from rostermart.llm import mix_sources as m

KIND = "doc_id long, text string, source string, key long, start int"


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 100, 1000, 4097])
def test_permutations(n):
    both = [m.permuted(np.arange(n), np.full(n, n), np.full(n, k)) for k in (1, 2)]
    assert all(sorted(p) == list(range(n)) for p in both)
    assert n < 16 or (both[0] != both[1]).any()


def test_targets():
    assert m.targets([100, 100, 100], [3, 1, 2], 1.5, 2) == pytest.approx([200, 250 / 3, 500 / 3])
    assert m.targets([10, 0, 990], [3, 1, 2], 1.5, 2) == pytest.approx([20, 0, 1480])
    assert m.targets([], [], 1.5, 2) == []
    assert sum(m.targets([5, 7, 1000, 3], [3, 1, 2, 3], 1.5, 2)) == pytest.approx(1.5 * 1015)


def documents(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"{s}{i}_{j}" for j in range(rng.integers(0, 200))), s) for s, n in (("b", 400), ("a", 60), ("é", 5), (None, 30)) for i in range(n)]
    rows += [(1000, None, "a"), (1001, "", "none"), (1002, "x y  z\n", None), (1002, "x y  z\n", None), (None, "q", "b"), (1003, "w " * 20000, "b")]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], KIND), rows


def test_mix(spark):
    docs, rows = documents(spark)
    mixed = m.mix_sources(docs.repartition(4), block_words=16, shard_slots=64)
    got = m.taken(mixed).collect()
    again = m.taken(m.mix_sources(docs.repartition(3), block_words=16, shard_slots=64)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows) and sum(r.size for r in got) == sum(len((t or "").split()) for _, t, _ in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert [s.name for s in mixed.sources] == ["a", "b", "none", "é", None]
    taken = {s.target: 0 for s in mixed.sources}
    for r in got:
        taken[r.target] += r.taken
    assert all(abs(t - n) <= 48 for t, n in taken.items())
    texts = mixed.texts(docs).collect()
    assert sum(len(r.text.split()) for r in texts) == sum(r.taken for r in got)
    assert max(len(r.text.split()) for r in texts) == 16
    known = {w for _, t, _ in rows for w in (t or "").split()}
    assert all(w in known for r in texts for w in r.text.split())
    uses = mixed.slots.groupBy("source_no", "pass", "block").count()
    assert uses.where("count > 1").count() == 0  # no block twice in one pass
    assert mixed.slots.groupBy("shard").count().agg({"count": "max"}).first()[0] == 64


def test_empty(spark):
    docs, _ = documents(spark)
    assert m.taken(m.mix_sources(docs.limit(0))).count() == 0
    assert {r.taken for r in m.taken(m.mix_sources(docs.where("text is null"))).collect()} == {0}


def test_small_sources_come_near_their_targets(spark):
    rows = [(10 * i + j, f"{s}{j} " * 6, s, 1, 2) for i, s in enumerate("abcdef") for j in range(10)]
    got = m.taken(m.mix_sources(spark.createDataFrame(rows, KIND))).collect()
    taken, wanted = dict.fromkeys(range(6), 0), {}
    for r in got:
        taken[r.doc_id // 10] += r.taken
        wanted[r.doc_id // 10] = r.target
    assert [round(wanted[i]) for i in range(6)] == [120, 50, 100, 120, 50, 100] and all(abs(taken[i] - wanted[i]) <= 1 for i in range(6))
    assert all(r.taken <= 2 * r.size for r in got)


def test_keys_tell_nulls_apart(spark):
    rows = [("a", None, "s"), (None, "a", "s")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    assert sorted((str(r.doc_id), r.size, r.taken) for r in m.taken(m.mix_sources(docs)).collect()) == [("None", 1, 2), ("a", 0, 0)]
