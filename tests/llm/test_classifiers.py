"""The byte network and the nearest labelled examples: held-out accuracy, exactness, defined cases."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rostermart.llm import labelled, quality_net, toxic_neighbours
from tests.llm import brute

LABELS = "doc_id long, quality int, toxic int, text string"
DOCS = "doc_id long, text string, score double, row string, source string"


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def accuracy(judged, labels, label):
    rows = judged.where("held_out").join(labels.select("doc_id", label), "doc_id").collect()
    return np.mean([r.predicted == r[label] for r in rows]), len(rows)


def odd_documents(spark):
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (None, "null id"), (4, "you idiot " * 60000)]
    return spark.createDataFrame([(*r, 0.5, "r", None) for r in rows], DOCS)


def test_quality_of_held_out_rows(tables):
    docs, labels = tables
    judged = quality_net.judged(docs, labels)
    right, n = accuracy(judged, labels, "quality")
    assert n > 50 and right > 0.85
    got = {r.doc_id: r.held_out for r in judged.collect()}
    assert len(got) == docs.count() and all(h == brute.held_out(i, 5) for i, h in got.items())


def test_toxicity_of_held_out_rows(tables):
    docs, labels = tables
    right, n = accuracy(toxic_neighbours.judged(docs, labels), labels, "toxic")
    assert n > 50 and right > 0.93


def test_sample_leaves_held_out_rows_alone(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)] + [(0, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 % 2, 0, "x") for i in range(300)] + [(1, 0, 0, ""), (2, None, 1, ""), (None, 1, 1, ""), (5, 7, 1, "")], LABELS)
    sample, share = labelled.training_sample(docs, labels, "quality", 20)
    rows = sample.collect()
    assert len(rows) == 40 and sum(r.y for r in rows) == 20
    assert not any(brute.held_out(r.doc_id, 5) for r in rows)
    assert 0.2 < share < 0.5


@pytest.mark.parametrize("judge", [quality_net.judged, toxic_neighbours.judged])
def test_defined_cases(spark, tables, judge):
    odd, (docs, labels) = odd_documents(spark), tables
    some = docs.select("doc_id", "text").limit(0).unionByName(odd.select("doc_id", "text"))
    no_labels = labels.limit(0)
    got = judge(odd, no_labels).collect()
    assert len(got) == 6 and {round(r.score, 6) for r in got} == {0.5}
    one = spark.createDataFrame([(i, 1, 1, "") for i in range(1, 9)], LABELS)
    assert {r.predicted for r in judge(odd, one).collect()} == {1}
    both = spark.createDataFrame([(i, int(i != 4), int(i == 4), "") for i in (1, 2, 3, 4, 6, 7, 8, 9)], LABELS)
    got = judge(odd, both).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert judge(some.limit(0), both).count() == 0


def test_stages_keep_all_columns(spark):
    odd = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 1, "")], LABELS)
    assert quality_net.keep_good(odd, labels.limit(0)).columns == odd.columns
    assert quality_net.keep_good(odd, labels.limit(0)).count() == 6
    assert toxic_neighbours.keep_clean(odd, labels.limit(0)).columns == odd.columns


def test_chunks_cover_all_bytes():
    for size in (0, 1, 511, 512, 513, 960, 961, 5000):
        text, starts = quality_net.chunk_bounds(np.array([size, 3]))
        mine = starts[text == 0]
        covered = {p for s in mine for p in range(s, min(size, s + quality_net.CHUNK))}
        assert covered == set(range(size)) and (np.diff(mine) < quality_net.CHUNK).all()
        assert all(s < max(size, 1) for s in mine)


def test_scores_do_not_depend_on_the_batch():
    net = quality_net.Net.new(1)
    texts = ["", "a b", "word " * 3000, None, "é" * 700]
    together = net.scores(pa.array(texts))
    assert np.allclose(together, [net.scores(pa.array([t], pa.string()))[0] for t in texts], atol=1e-6)


def test_network_gradients():
    rng = np.random.default_rng(3)
    net = quality_net.Net.new(2)
    for w in net.weights():
        w += rng.normal(0, 0.05, w.shape).astype(np.float32)
    chunks, text = rng.integers(0, 256, (5, quality_net.CHUNK)), np.array([0, 0, 1, 2, 2])
    y, weight = np.array([1.0, 0.0, 1.0], np.float32), np.ones(3, np.float32)

    def loss():
        p = net.head(np.concatenate([net.largest(chunks)]), text, 3)
        return -(np.log(np.where(y == 1, p, 1 - p))).sum()

    found = quality_net._gradients(net, chunks, text, y, weight)
    for w, g in list(zip(net.weights(), found, strict=True))[1:]:
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = w[at]
        w[at] = old + 1e-2
        up = loss()
        w[at] = old - 1e-2
        down = loss()
        w[at] = old
        assert (up - down) / 2e-2 == pytest.approx(float(g[at]), rel=0.15, abs=1e-3)


def test_nearest_equals_a_scan():
    rng = random.Random(6)
    clean, bad = [f"w{i}" for i in range(40)], [f"bad{i}" for i in range(12)]
    rows = [(f"{i}", " ".join(rng.choices(clean, k=30) + (rng.choices(bad, k=rng.randrange(1, 6)) if i % 2 else [])), i % 2) for i in range(400)]
    sample = pd.DataFrame(rows, columns=["doc_id", "text", "y"])
    terms = toxic_neighbours.choose_terms(sample)
    index = toxic_neighbours.build(sample, terms, np.arange(len(terms)) + 5.0, 1000, 0.5)
    assert len(terms) and index.largest.shape[1] == 7
    dense = np.zeros((400, len(terms)))
    place = {n: k for k, n in enumerate(index.names)}
    for lo, _, r, t, w in index.vectors(pa.array(sample["text"])):
        dense[[place[rows[lo + i][0]] for i in r], t] = w
    for lo, n, r, t, w in index.vectors(pa.array([" ".join(rng.choices(clean + bad, k=8)) for _ in range(60)])):
        for i in range(n):
            q = np.zeros(len(terms))
            q[t[r == i]] = w[r == i]
            sims = (dense @ q).round(12)
            want = [(s, e) for s, e in sorted(zip(-sims, range(400), strict=True)) if s < 0][:toxic_neighbours.K]
            got, ids = index.nearest(t[r == i], w[r == i])
            assert ids.tolist() == [e for _, e in want] and np.allclose(got, [-s for s, _ in want])


def rare_words(seed):
    """Texts of 400 examples; every toxic one has a word that only three others have."""
    rng = random.Random(seed)
    rows = [(f"{i}", " ".join(rng.choices([f"w{k}" for k in range(60)], k=25) + [f"x{rng.randrange(150)}"] + ([f"vile{i // 2 % 50}"] if i % 2 else [])), i % 2) for i in range(400)]
    return pd.DataFrame(rows, columns=["doc_id", "text", "y"])


def test_terms_of_few_examples_count():
    sample = rare_words(3)
    terms = toxic_neighbours.choose_terms(sample)
    assert set(terms.view(np.uint64)) == {h for part in toxic_neighbours.terms_of(pa.array(sample["text"])) for h in part[3].tolist()}
    index = toxic_neighbours.build(sample, terms, np.full(len(terms), 8.0), 1000, 0.5)
    raw = {}
    for text in ("w1 w2 w3 vile7", "w1 w2 w3", "vile7", "x3"):
        ((_, n, r, t, w),) = index.vectors(pa.array([text]))
        sims, ids = index.nearest(t, w)
        assert len(ids)
        raw[text] = index.raw(sims, ids)
    assert raw["w1 w2 w3 vile7"] > raw["w1 w2 w3"] and index.score(raw["vile7"]) > 0.5


def test_an_index_is_opened_without_copies_of_all_postings():
    """Two million postings take 24 MB as examples and weights; what is made on the way stays small beside that."""
    many, examples, terms = 1 << 21, 4096, 1 << 14
    index = toxic_neighbours.Index(
        np.arange(terms, dtype=np.uint64) << np.uint64(50), np.ones(terms), 0.5, np.zeros(examples, np.int64), [], np.zeros(0), np.full(terms, -1),
        np.zeros((0, 0, 64)), np.zeros((0, 0)), np.arange(terms + 1) * (many // terms), np.tile(np.arange(many // terms, dtype=np.uint16), terms),
        np.zeros(0), tf=np.ones(many, np.uint8), length=np.ones(examples))
    tracemalloc.start()
    try:
        index._weigh()
        assert tracemalloc.get_traced_memory()[1] < 48 << 20
    finally:
        tracemalloc.stop()
    assert (index.weights == 1).all()


def test_an_index_is_built_in_little_more_than_it_takes():
    """Two million postings, with the rows of common terms beside them: 83 MB at most at a time, 279 before."""
    rng = np.random.default_rng(8)
    rows = [(f"{i}", " ".join(f"q{x}" for x in rng.integers(10_000, 30_000, 500)), i % 2) for i in range(2000)]
    sample = pd.DataFrame(rows, columns=["doc_id", "text", "y"])
    terms = toxic_neighbours.choose_terms(sample)
    tracemalloc.start()
    try:
        index = toxic_neighbours.build(sample, terms, np.full(len(terms), 8.0), 5000, 0.5)
        assert tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()
    assert len(index.ids) > 2_000_000


def test_an_open_index_holds_only_what_is_searched():
    sample = rare_words(5)
    terms = toxic_neighbours.choose_terms(sample)
    index = toxic_neighbours.build(sample, terms, np.full(len(terms), 8.0), 1000, 0.5)
    opened = labelled.unpacked(labelled.packed(index))
    assert opened.ids is None and opened.tf is None and len(opened.rare) == len(opened.weights) < len(index.ids)
    ((_, n, r, t, w),) = index.vectors(pa.array(sample["text"]))
    for a, b in zip(index.nearest_of(n, r, t, w), opened.nearest_of(n, r, t, w), strict=True):
        assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_groups_of_texts_have_one_size(monkeypatch):
    sample = rare_words(6)
    terms = toxic_neighbours.choose_terms(sample)
    index = toxic_neighbours.build(sample, terms, np.full(len(terms), 8.0), 1000, 0.5)
    sizes, real = [], toxic_neighbours.Index._similarities
    monkeypatch.setattr(toxic_neighbours.Index, "_similarities", lambda self, n, *rest: sizes.append(n) or real(self, n, *rest))
    ((_, n, r, t, w),) = index.vectors(pa.array(sample["text"][:130]))
    assert len(list(index.nearest_of(n, r, t, w))) == 130 and sizes == [65, 65]
    assert not list(index.nearest_of(0, r[:0], t[:0], w[:0]))


def test_rows_come_back_whole_from_all_runs(spark):
    texts = [f"{'idiot' if i % 2 else 'kind'} word{i} " * 20_000 for i in range(8)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    rows = toxic_neighbours.judge(docs, toxic_neighbours.fit(docs, labels)).collect()
    assert sorted((r.row.doc_id, r.row.text == texts[r.row.doc_id], bool(r.evidence)) for r in rows) == [(i, True, i < 8) for i in range(10)]


@pytest.mark.parametrize("never", [True, False])
def test_samples_whose_columns_are_never_null_are_fitted(spark, never):
    rows = spark.range(40, numPartitions=3).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit(1).alias("y"))
    sample = rows if never else rows.select(*[F.when(F.col("doc_id") >= 0, F.col(c)).alias(c) for c in rows.columns])
    assert all(f.nullable != never for f in sample.schema)
    got = labelled.fitted(sample, lambda s: (list(s["doc_id"]), s["text"][0], int(s["y"].sum())))
    assert got == (sorted(str(i) for i in range(40)), "text 0", 40)
    assert labelled.fitted(sample.limit(0), len) == 0


def test_texts_come_in_small_batches(spark):
    docs = spark.createDataFrame([(i, "some words " * 10_000) for i in range(200)], "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, toxic int")
    toxic_neighbours.judge(docs, toxic_neighbours.fit(docs, labels))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    rows = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(rows) == 200 and max(rows) <= 60


def test_distinct_keys():
    for keys in ([], [3], [5, 1, 5, 1, 2], list(range(50)) * 2):
        keys = np.array(keys, np.int64)
        assert np.array_equal(toxic_neighbours._distinct(keys), np.unique(keys))


def test_nearest_equals_a_scan_over_rare_terms():
    sample = rare_words(4)
    terms = toxic_neighbours.choose_terms(sample)
    index = toxic_neighbours.build(sample, terms, np.arange(len(terms)) % 90 + 1.0, 1000, 0.5)
    assert len(index.largest) and len(index.ids)
    dense = np.zeros((448, len(terms)))
    place = {n: k for k, n in enumerate(index.names)}
    for lo, _, r, t, w in index.vectors(pa.array(sample["text"])):
        dense[[place[sample["doc_id"][lo + i]] for i in r], t] = w
    asked = pa.array([*sample["text"][:150], "", "vile3 vile4", "nothing", "x1 x2 x3", "w1"])
    ((_, n, r, t, w),) = index.vectors(asked)
    skip = np.array([place[str(i)] for i in range(150)] + [-1] * 5)
    for i, (sims, ids) in enumerate(index.nearest_of(n, r, t, w, skip)):
        q = np.zeros(len(terms))
        q[t[r == i]] = w[r == i]
        each = (dense @ q).round(12)
        want = [(s, e) for s, e in sorted(zip(-each, range(448), strict=True)) if s < 0 and e != skip[i]][:toxic_neighbours.K]
        assert ids.tolist() == [e for _, e in want] and np.allclose(sims, [-s for s, _ in want])


def test_documents_of_each_term(spark):
    texts = ["idiot one", "idiot idiot two", None, "", "three", "one two three four"] * 7
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    terms = toxic_neighbours.choose_terms(pd.DataFrame({"text": ["idiot", "one zebra"], "y": [1, 0]}))
    df, n = toxic_neighbours.count_documents(docs, terms)
    hashes = {w: int(h.view(np.int64)) for w in ("idiot", "one", "zebra") for h in [next(toxic_neighbours.terms_of(pa.array([w])))[3][0]]}
    assert n == 42 and {w: df[terms.tolist().index(h)] for w, h in hashes.items()} == {"idiot": 14, "one": 14, "zebra": 0}


def test_training_sees_all_chunks(monkeypatch):
    texts = ["good words " * 3000, "junk " * 20, "", "é" * 20000]
    seen, real = [], quality_net._gradients
    monkeypatch.setattr(quality_net, "_gradients", lambda net, chunks, *rest: seen.append(len(chunks)) or real(net, chunks, *rest))
    quality_net.train(pd.DataFrame({"text": texts, "y": [1, 0, 0, 1]}), steps=1)
    assert seen == [len(quality_net.chunk_bounds(np.array([len(t.encode()) for t in texts]))[0])]


def test_gradients_do_not_depend_on_kept_windows(monkeypatch):
    chunks, net = quality_net.Cuts.of([b"some words " * 4000, b"", b"x" * 30000]), quality_net.Net.new(3)
    args = net, chunks, chunks.text, np.array([1, 0, 1], np.float32), np.ones(3, np.float32)
    kept = quality_net._gradients(*args)
    monkeypatch.setattr(quality_net, "KEPT", 0)
    assert all(np.array_equal(a, b) for a, b in zip(kept, quality_net._gradients(*args), strict=True))


def test_filters_look_at_every_byte():
    net = quality_net.Net.new(4)
    chunks = np.full((2, quality_net.CHUNK), 32)
    for row, at in enumerate((100, 101)):
        chunks[row, at:at + 30] = np.arange(97, 127)
    assert np.allclose(*net.largest(chunks), atol=1e-5) and np.allclose(*net.pooled(chunks)[0], atol=1e-5)


def test_workers_that_wait_hold_no_index(spark):
    docs = spark.createDataFrame([(i, f"{'idiot' if i % 2 else 'kind'} word{i}") for i in range(40)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    scored = toxic_neighbours.judged(docs, labels).collect()
    assert all(r.evidence and r.evidence[0].label == r.predicted == r.doc_id % 2 for r in scored)

    def held(batches):
        import gc

        list(batches)
        yield pa.RecordBatch.from_arrays([pa.array([sum(type(o).__name__ == "Index" and hasattr(o, "ids") for o in gc.get_objects())])], names=["n"])

    for _ in range(3):
        assert {r.n for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}
