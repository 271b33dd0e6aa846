import random
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rostermart.llm import language_id as l
from rostermart.llm.texts import BYTE_VALUES, LETTERS, slices

KIND = "doc_id long, text string, lang string, source string, score double, lang_pred string, rejected boolean"
SYLLABLES = {"aa": "ka mo ti su ne ro".split(), "bb": "schl über ndt eich kr ung".split(), "cc": "ção nhe lla qu ei ões".split()}


def say(lang, words, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))).capitalize() for _ in range(words))


def table(spark, rows):
    return spark.createDataFrame([(i, t, k, "s", 0.0, "x", True) for i, t, k in rows], KIND).repartition(3)


def plain_subwords(text):
    """(length, bytes) of each subword; a byte outside words, and either end of a text, is a mark (None)."""
    raw = [None, *(b + 32 if 65 <= b <= 90 else b for b in text.encode()), None]
    raw = [b if b is not None and LETTERS[b] else None for b in raw]
    out = []
    for size in l.SIZES:
        for i in range(len(raw) - size + 1):
            gram = raw[i:i + size]
            middle = gram[1:-1]
            if (gram[0] is not None or gram[-1] is not None) and all(b is not None for b in middle):
                out.append((size, tuple(gram)))
    return out


def bucket(size, gram):
    code = 0
    for b in gram:
        code = (code * int(l._TURN) + (1 if b is None else int(BYTE_VALUES[b]))) % (1 << 64)
    x = (code + size) % (1 << 64)
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) % (1 << 64)
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) % (1 << 64)
    return (x ^ (x >> 31)) % l.BUCKETS


def test_equals_a_plain_forward_pass():
    rng = np.random.default_rng(0)
    model = l.Model(["a", "b", "c"], rng.standard_normal((l.BUCKETS, l.VECTOR)).astype(np.float32), rng.standard_normal((l.VECTOR, 3)), rng.standard_normal(3), 1.7, 0.5)
    texts = ["Der  HUND", "é", "a", "", None, "12 ?", "x\n\ny z.", "漢字かな ab", "w" * 3000 + " Q"]
    lang, score, rejected = model.predict(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        if not any(unicodedata.category(c).startswith("L") for c in text or ""):
            assert (lang[i].as_py(), score[i], rejected[i]) == ("und", 0, True)
            continue
        mean = np.mean([model.vectors[bucket(*s)] for s in plain_subwords(text)], axis=0)
        z = (mean @ model.weights + model.bias) / 1.7
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert lang[i].as_py() == model.langs[p.argmax()] and abs(score[i] - p.max()) < 1e-5 and rejected[i] == (p.max() < 0.5)


def test_slices_do_not_change_answers():
    rng = random.Random(1)
    column = pa.array([say("bb", rng.randint(0, 90), rng) for _ in range(60)] + [None])
    model = l.Model(["a", "b"], np.random.default_rng(2).standard_normal((l.BUCKETS, l.VECTOR)), np.ones((l.VECTOR, 2)), np.zeros(2))
    whole = np.concatenate([model.means(p) for p in slices(column)])
    apart = np.concatenate([model.means(p) for p in slices(column, 40)])
    assert np.allclose(whole, apart)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(7)
    rows = [(i, say(k, rng.choice([1, 3, 30, 200]), rng), k) for i, k in enumerate(rng.choices(["aa", "bb", "cc"], [8, 3, 1], k=600))]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 ?!", "cc"), (1003, say("cc", 9, rng), None), (1003, say("cc", 9, rng), "zz"), (None, say("aa", 9, rng), "aa"),
             (1004, "漢字 かな", None), (1005, " ".join([say("bb", 9000, rng)]), None)]
    rows += [(2000 + i, rows[0][1], None) for i in range(3)]
    return rows, l.judged(table(spark, rows)).collect()


def test_held_out_accuracy(judged):
    rows, got = judged
    assert len(got) == len(rows)
    truth = {i: (t, k) for i, t, k in rows if i is not None and i < 1000}
    held = [(r, truth[r.doc_id]) for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held) and len(held) > 60
    assert np.mean([r.lang_pred == k for r, (_, k) in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    sure = [r.score for r, (_, k) in held]
    assert abs(np.mean(sure) - np.mean([r.lang_pred == k for r, (_, k) in held])) < 0.1


def test_cases(judged):
    _, got = judged
    found = {r.doc_id: r for r in got}
    assert all((found[i].lang_pred, found[i].score, found[i].rejected) == ("und", 0.0, True) for i in (1000, 1001, 1002))
    assert found[1005].lang_pred == "bb" and not found[1005].rejected
    assert found[1004].rejected and found[1004].lang_pred in ("aa", "bb", "cc", "zz")
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id in (0, 2000, 2001, 2002)}) == 1
    assert sum(r.doc_id == 1003 for r in got) == 2 and found[None].held_out


def test_nothing_to_learn_from(spark):
    got = l.judged(table(spark, [(0, "some text", None), (1, None, "aa")])).collect()
    assert {(r.doc_id, r.lang_pred, r.score) for r in got} == {(0, "und", 0.0), (1, "und", 0.0)}
    assert l.judged(table(spark, [(0, "x", "aa")]).limit(0)).count() == 0
    one = l.judged(table(spark, [(i, f"ka mo {i}", "aa") for i in range(12)])).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("aa", 1.0)}


def test_sample_is_bounded_and_keeps_rare_languages(spark):
    rows = [(i, f"ka mo {i}", "aa") for i in range(400)] + [(i, f"schl {i}", "bb") for i in range(400, 410)]
    some = l.training_bags(table(spark, rows), per_lang=20, rows=24).collect()
    assert len(some) == 24 and sum(r.lang == "bb" for r in some) >= 4
    whole = l.training_bags(table(spark, [(1, "ka " * 5000, "aa")]), 5, 5).collect()
    assert sum(whole[0].counts) == 5000 * 5
