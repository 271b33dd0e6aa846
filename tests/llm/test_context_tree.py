import math
import random
from collections import Counter

import numpy as np
import pytest

from rostermart.llm import context_tree as c
from tests.llm import brute

D = c.DEPTH


def coded(text):
    return brute.lower(text).encode() + b"\xff"


def tree_score(learned, text):
    """Context-tree weighting written out node by node."""
    counts = {}
    for t in learned:
        run = b"\xff" * D + coded(t)
        for i in range(D, len(run)):
            for d in range(D + 1):
                node = 1
                for k in range(8):
                    bit = run[i] >> (7 - k) & 1
                    counts.setdefault((run[i - d:i], node), [0, 0])[bit] += 1
                    node = 2 * node + bit
    children = {}
    for context, node in counts:
        if context:
            children.setdefault((context[1:], node), []).append((context, node))

    def own(key):
        a, b = counts[key]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    block = {}
    for key in sorted(counts, key=lambda k: -len(k[0])):
        below = sum(block[x] for x in children.get(key, ()))
        block[key] = own(key) if len(key[0]) == D else np.logaddexp(own(key), below) - math.log(2)
    total, run = 0.0, b"\xff" * D + coded(text)
    for i in range(D, len(run)):
        node = 1
        for k in range(8):
            bit, p = run[i] >> (7 - k) & 1, None
            for d in range(D, -1, -1):
                key = (run[i - d:i], node)
                if key in counts:
                    mine = (counts[key][bit] + .5) / (sum(counts[key]) + 1)
                    if p is None:
                        p = mine
                    else:
                        odds = math.exp(min(700, own(key) - sum(block[x] for x in children[key])))
                        p = mine if math.isinf(odds) else (odds * mine + p) / (odds + 1)
            total += math.log10(0.5 if p is None else p)
            node = 2 * node + bit
    return total


def base(learned, text):
    n = Counter(w for t in learned for w in [*brute.words(t), 0])
    every, least = sum(n.values()), 0.1 * (len(n) + 1)
    said = [*brute.words(text), 0]
    return len(said), sum(n[w] > 0 for w in said), every, sum(math.log10((n[w] + .1) / (every + least)) for w in said)


@pytest.mark.parametrize("block_bytes", [200, 1 << 25])
def test_equals_the_tree_written_out(spark, tmp_path, block_bytes):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "Then", "of", "és", "off\n"]) for _ in range(rng.randrange(30))) for _ in range(60)]
    rows = [*enumerate(texts), (60, None), (61, ""), (62, "the"), (62, "the"), (None, "Q" * 300), (63, "漢字 new words 123")]
    made = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, block int, split string").repartition(3)
    made.write.parquet(str(tmp_path / "docs"))
    learned = [t for i, t in rows if not brute.held_out(i, 10)]
    for docs in (spark.read.parquet(str(tmp_path / "docs")), made) if block_bytes > 200 else (made,):
        got = c.score(docs, block_bytes=block_bytes).collect()
        want = sorted((str(i), base(learned, t), tree_score(learned, t)) for i, t in rows)
        have = sorted((str(r.doc_id), (r.n_tokens, r.n_known, r.train_tokens, r.base_score), r.score) for r in got)
        assert len(have) == len(want)
        for (i, b, s), (j, b2, s2) in zip(want, have, strict=True):
            assert i == j and b[:3] == b2[:3] and b2[3] == pytest.approx(b[3], rel=1e-6) and s2 == pytest.approx(s, rel=1e-5)
        assert {str(r.doc_id): r.held_out for r in got} == {str(i): brute.held_out(i, 10) for i, _ in rows}


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    seen = np.unique(rng.integers(97, 103, (400, D + 1)) @ (256 ** np.arange(D, -1, -1))).astype(np.uint64)
    n = rng.integers(1, 9, len(seen))
    every = np.unique(np.concatenate([(seen[:50, None] & ~np.uint64(255) | np.arange(256, dtype=np.uint64)).reshape(-1),
                                      np.arange(256, dtype=np.uint64) | np.uint64(0x6162637A7A00), np.arange(256, dtype=np.uint64) | np.uint64(0x010203040500), seen]))
    counts = np.zeros(len(every), np.int64)
    counts[np.searchsorted(every, seen)] = n
    sums = np.zeros((3, 256 * 256))
    for batch in c._tops(iter([__import__("pyarrow").RecordBatch.from_arrays([every.view(np.int64), counts], names=["key", "n"])])):
        for k, name in enumerate(("n0", "n1", "below")):
            np.add.at(sums[k], np.asarray(batch.column("slot")), np.asarray(batch.column(name)))
    p = 10 ** c.log10_of(every, counts, c.Top.of(*(s.reshape(256, 256) for s in sums)))
    context = every >> np.uint64(8)
    whole = [x for x in np.unique(context) if (context == x).sum() == 256]
    assert len(whole) >= 3
    for x in whole:
        assert p[context == x].sum() == pytest.approx(1)


def test_nothing_learned_and_empty(spark):
    docs = spark.createDataFrame([(i, "ab") for i in range(200) if brute.held_out(i, 10)], "doc_id long, text string")
    assert {round(r.score, 6) for r in c.score(docs).collect()} == {round(-24 * math.log10(2), 6)}
    assert c.score(docs.limit(0)).count() == 0
