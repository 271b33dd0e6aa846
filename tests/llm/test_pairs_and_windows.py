"""Decontamination and near-duplicates beside brute force."""

import hashlib
import random

import numpy as np
import pytest

from rostermart.llm import decontaminate, near_dedup
from tests.llm import brute

DOCS = "doc_id long, text string, row string, n_words string, found string"
ITEMS = "item_id long, text string, words string"


def contamination(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, named = brute.words(text, brute.LETTERS), set(), set()
        for item, said in items:
            v = brute.words(said, brute.LETTERS)
            size = min(window, len(v))
            for s in range(len(v) - size + 1 if size else 0):
                for at in range(len(w) - size + 1):
                    if w[at:at + size] == v[s:s + size]:
                        hit |= set(range(at, at + size))
                        named.add("" if item is None else str(item))
        out.append((doc_id, len(w), len(hit), sorted(named)))
    return sorted(out, key=str)


def test_contamination(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["der", "été"]
    said = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, said(25)), (2, said(10)), (3, "Only, three words"), (4, "single"), (5, None), (6, " ?! "), (None, said(12)), (7, said(14)), (7, "second row of seven")]
    texts = {i: t for i, t in items if t}
    docs = [(0, None), (1, ""), (2, said(40) + " " + texts[1] + "! " + said(5)), (3, texts[2].upper()), (4, "x ONLY three; WORDS only three words"),
            (5, "a single b single"), (6, " ".join(texts[1].split()[:9])), (7, said(3000) + " " + texts[7] + " " + said(3000)),
            (8, texts[1] + " " + texts[1]), (8, texts[1] + " " + texts[1]), (None, "here " + texts[None]), (9, "second row of seven")]
    found = decontaminate.find_contamination(
        spark.createDataFrame([(*d, "x", None, "y") for d in docs], DOCS).repartition(3), spark.createDataFrame([(*i, "z") for i in items], ITEMS))
    mine = sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=str)
    assert mine == contamination(docs, items)
    clean = decontaminate.decontaminate(spark.createDataFrame([(*d, "x", None, "y") for d in docs], DOCS), spark.createDataFrame([(*i, "z") for i in items], ITEMS))
    assert clean.columns == ["doc_id", "text", "row", "n_words", "found"]
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, _, n, _ in contamination(docs, items) if not n)


def test_contamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.find_contamination(docs.limit(0), items).count() == 0
    assert decontaminate.find_contamination(docs, items.limit(0)).first().n_hit == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
    sets = [np.concatenate([shared, a]), np.concatenate([shared, b]), shared[:3], np.zeros(0, np.uint64)]
    signatures = near_dedup.super_minhash(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert abs((signatures[0] == signatures[1]).mean() - 0.8) < 0.12
    places = [near_dedup.super_minhash(s, np.array([0, len(s)]))[0] for s in sets[:3]]
    assert all((signatures[i] == p).all() for i, p in enumerate(places))
    assert len(np.unique(signatures[2] & np.uint64(0xFFFFFFFF))) > 100  # every place is filled
    assert (signatures[2] >> np.uint64(32)).max() < near_dedup.PLACES


def test_each_shingle_deals_a_permutation():
    one = near_dedup.super_minhash(np.array([12345], np.uint64), np.array([0, 1]))[0]
    assert sorted((one >> np.uint64(32)).tolist()) == list(range(near_dedup.PLACES))


def family(rng, n, length=60):
    base = [f"t{rng.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(length)] = f"n{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def test_groups(spark):
    rng = random.Random(5)
    texts = [t for n in (1, 1, 2, 3, 40, 12) for t in family(rng, n)] + ["", None, "one", "One", "two words", "two  words", "a b c", "x y z", " \n"]
    chain = [f"c{i}" for i in range(80)]
    for step in range(0, 12, 2):  # each like the next, the ends unlike
        texts.append(" ".join([f"s{i}" for i in range(step)] + chain[step:]))
    texts.append(" ".join(f"long{i % 4000}" for i in range(30000)))
    rng.shuffle(texts)
    by_id = dict(enumerate(texts))
    for k, percent in ((3, 85), (5, 80)):
        docs = spark.createDataFrame([(i, t, "clash") for i, t in by_id.items()], "doc_id long, text string, cls string").repartition(4)
        rows = near_dedup.near_duplicates(docs, k, percent).collect()
        assert {r.doc_id: r.component_id for r in rows} == brute.grouped(by_id, k, percent)
        assert {r.doc_id: r.n_shingles for r in rows} == {i: len(brute.shingles(t, k)) for i, t in by_id.items()}


def test_texts_that_are_alike_and_not_linked_make_few_pairs(spark, monkeypatch):
    rng, sent, plausible = random.Random(8), [], near_dedup._plausible

    def counted(pairs, least):
        sent.append(pairs.count())
        return plausible(pairs, least)

    monkeypatch.setattr(near_dedup, "_plausible", counted)
    base, texts = [f"b{i}" for i in range(100)], []
    for _ in range(300):
        own = list(base)
        for at in rng.sample(range(100), 2):
            own[at] = f"n{rng.randrange(10 ** 9)}"
        texts.append(" ".join(own))
    by_id = dict(enumerate(texts))
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(by_id.items()), "doc_id long, text string"), 3, 85).collect()
    expected = brute.grouped(by_id, 3, 85)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert len(set(expected.values())) > 1
    assert sum(sent) < 300 * 299 / 2 / 4


def test_parities_bound_the_difference():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2 ** 63, 3000).astype(np.uint64)
    sets = [np.sort(rng.choice(pool, n, replace=False)) for n in (0, 1, 50, 60, 2900, 2950)]
    bits = near_dedup.parities(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert bits.shape == (6, near_dedup.PARITIES // 32) and not bits[0].any()
    for x, a in zip(sets, bits, strict=True):
        for y, b in zip(sets, bits, strict=True):
            odd, differ = int(np.bitwise_count(a ^ b).sum()), len(np.setxor1d(x, y))
            assert odd <= differ and (odd - differ) % 2 == 0


def test_full_sets_are_compared_for_pairs_near_the_threshold_only(spark, monkeypatch):
    rng, compared, met = random.Random(9), [], []
    verified, prefix_pairs = near_dedup._verified, near_dedup._prefix_pairs

    def counted(pairs, texts, k, percent):
        links = verified(pairs, texts, k, percent)
        compared.append((pairs.count(), links.count()))
        return links

    def counted_pairs(*args):
        pairs = prefix_pairs(*args)
        met.append(pairs.distinct().count())
        return pairs

    monkeypatch.setattr(near_dedup, "_verified", counted)
    monkeypatch.setattr(near_dedup, "_prefix_pairs", counted_pairs)
    base, texts = [f"b{i}" for i in range(120)], []
    for _ in range(250):  # words that go leave shingles which all share that lost the same one
        own = list(base)
        for at in sorted(rng.sample(range(120), rng.randrange(2, 8)), reverse=True):
            own[at:at + 1] = [f"n{rng.randrange(40)}"] * rng.randrange(2)
        texts.append(" ".join(own))
    by_id = dict(enumerate(texts))
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(by_id.items()), "doc_id long, text string"), 3, 85).collect()
    expected = brute.grouped(by_id, 3, 85)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert sum(pairs for pairs, _ in compared) <= 2 * sum(links for _, links in compared) + 20
    assert sum(met) < 250 * 249 / 2 / 20


def test_links_inside_a_group_are_not_all_compared(spark, monkeypatch):
    sent, plausible = [], near_dedup._plausible

    def counted(pairs, least):
        sent.append(pairs.count())
        return plausible(pairs, least)

    monkeypatch.setattr(near_dedup, "_plausible", counted)
    rng, base, texts = random.Random(12), [f"b{i}" for i in range(120)], []
    for i in range(300):  # a third differ little from each other, and the others differ from many of them by about as much as links may
        own = list(base)
        for at in rng.sample(range(120), 3 if i % 3 else 1):
            own[at] = f"n{at}-{rng.randrange(2)}"
        texts.append(" ".join(own))
    by_id = dict(enumerate(texts))
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(by_id.items()), "doc_id long, text string"), 3, 85).collect()
    expected = brute.grouped(by_id, 3, 85)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert sum(sent[1:]) < 300


@pytest.mark.parametrize(("k", "percent"), [(1, 50), (2, 80), (3, 85)])
def test_groups_of_random_edits(spark, k, percent):
    rng, texts = random.Random(100 * k + percent), []
    for _ in range(6):
        family_base = [f"v{rng.randrange(60)}" for _ in range(rng.randrange(8, 50))]
        for _ in range(25):
            own = list(family_base)
            for _ in range(rng.randrange(1, 6)):
                at = rng.randrange(len(own))
                own[at:at + rng.randrange(2)] = [f"v{rng.randrange(80)}"] * rng.randrange(3)
                own = own or ["v0"]
            texts.append(" ".join(own))
    by_id = dict(enumerate(texts))
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(by_id.items()), "doc_id long, text string").repartition(3), k, percent).collect()
    found, expected = {r.doc_id: r.component_id for r in rows}, brute.grouped(by_id, k, percent)
    if percent > 50:  # at 0.5 the bands themselves miss pairs; there no link may be made up
        assert found == expected
    for doc_id, low in found.items():
        assert expected[doc_id] == expected[low]


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "p q r s t u"), (3, None), (3, None), (4, "")]
    copies = spark.createDataFrame([(i, f"the same words {i // 10} for all of these") for i in range(300)], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup.deduplicate(copies).collect()) == list(range(0, 300, 10))
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, row long")
    found = near_dedup.near_duplicates(docs)
    assert sorted((r.doc_id, r.component_id) for r in found.where("n_shingles = 3").collect() if r.doc_id) == [(1, 1), (1, 1), (2, 1)]
    assert [r.component_id for r in found.where("n_shingles = 2").collect()] == [None]
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == ["doc_id", "text", "row"]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect() if r.text) == [("1", "a b c d e f g"), ("None", "p q r s t u")]
    assert kept.where("text is null or text = ''").count() == 3
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("task_edges", [1000, 9])
def test_components(spark, task_edges):
    digest = lambda i: hashlib.md5(str(i).encode()).digest()
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 150)] + [(149, 200), (300, 301)]
    rows = near_dedup.components(spark.createDataFrame([(digest(a), digest(b)) for a, b in links], "a binary, b binary"), task_edges).collect()
    sets = [set(range(21)), {*range(100, 150), 200}, {300, 301}]
    assert {bytes(r.node): bytes(r.root) for r in rows} == {digest(i): min(map(digest, s)) for s in sets for i in s}
    assert len(rows) == sum(map(len, sets))


def test_text_ids_and_null_texts_are_told_apart(spark):
    docs = spark.createDataFrame([("a", None, 1), (None, "a", 2), ("b", "one two three four five six", 3), ("c", "one two three four five six", 4)],
                                 "doc_id string, text string, n int")
    kept = near_dedup.deduplicate(docs, k=5, percent=80).collect()
    assert sorted(r.n for r in kept) == [1, 2, 3]
    items = spark.createDataFrame([("x", "a")], "item_id string, text string")
    found = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.find_contamination(docs, items).collect()}
    assert found == {"a": (0, 0), None: (1, 1), "b": (6, 0), "c": (6, 0)}
