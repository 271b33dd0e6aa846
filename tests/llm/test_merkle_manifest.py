import hashlib
import random

from pyspark.sql import functions as F

from rostermart.llm import merkle_manifest as m

KIND = "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank int, k string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    said = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)]
    return digest("".join(said))


def tree(nodes):
    """The root and, for each node, its siblings before and after it, level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, path in enumerate(paths):
            first = at[i] // 8 * 8
            path.append(("".join(level[first:at[i]]), "".join(level[at[i] + 1:first + 8])))
            at[i] //= 8
        level = [digest("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
    return level[0], paths


def brute(rows):
    """(doc_id, lang, rank, leaf, subroot, root, proof, folded from the claimed text) of each row; claims: texts of ids that 3 divides."""
    langs = sorted({r[2] for r in rows}, key=lambda k: (k is not None, (k or "").encode()))
    found = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        found[lang] = (mine, *tree([leaf(r, r[1]) for r in mine]))
    root, above = tree([found[k][1] for k in langs])
    out = []
    for at, lang in enumerate(langs):
        mine, subroot, paths = found[lang]
        for rank, (r, path) in enumerate(zip(mine, paths, strict=True)):
            folded = leaf(r, claim(r))
            for before, after in path + above[at]:
                folded = digest(before + folded + after)
            out.append((r[0], lang, rank, leaf(r, r[1]), subroot, root, digest("".join(b + a for b, a in path + above[at])), folded, folded == root))
    return sorted(out, key=repr)


def claim(r):
    return r[1].lower() if r[0] is not None and r[0] % 3 == 0 and r[1] is not None else r[1]


def claim_column():
    return F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))


def got(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], KIND).repartition(3)
    made = m.build(table, claim_column())
    return sorted(map(tuple, m.proofs(made, **more).collect()), key=repr), made


def test_equals_a_plain_tree(spark):
    random.seed(4)
    rows = [(i, random.choice(["Ab", "cd", "", None, "É" * 9]), random.choice(["en", "en", "en", "de", None, "é"]), random.choice(["s", None]), random.choice([3, None]))
            for i in random.sample(range(-2000, 40000), 3000)]
    rows += [(i << 40, "Far", "en", "s", 1) for i in (-3, 1, 2, (1 << 22) + 7)] + [(7, "Lone", "zz", "s", 1), ((1 << 63) - 1, "X", "de", "s", 1), (-(1 << 63), "Y", "de", "s", 1)]
    have, made = got(spark, rows)
    assert have == brute(rows) and len(made.leaf_rounds) == 2
    assert any(r[-1] for r in have) and not all(r[-1] for r in have)


def test_repeated_and_null_ids(spark):
    random.seed(5)
    rows = [(i, "T", "en", "s", 1) for i in range(900)] + [(64, f"Copy {i % 40}", "en", "s", 1) for i in range(700)] + [(70, "T", "en", "s", 1)] * 5
    rows += [(None, random.choice("ABC"), random.choice(["en", None]), None, None) for _ in range(60)]
    have, _ = got(spark, rows)
    assert have == brute(rows)


def test_many_copies_are_dealt_in_runs(spark, monkeypatch):
    monkeypatch.setattr(m, "COPIES", 16)
    monkeypatch.setattr(m, "TOP", 2)
    rows = [(5, "Same", "en", "s", 1)] * 100 + [(i << 20, f"Other {i}", "en", "s", 1) for i in range(50)]
    assert got(spark, rows)[0] == brute(rows)


def test_many_languages(spark):
    rows = [(i, "T", f"l{i % 700}", "s", 1) for i in range(1500)]
    have, made = got(spark, rows)
    assert have == brute(rows) and len(made.lang_rounds) == 2


def test_paths_lead_to_the_root(spark):
    rows = [(i, f"Text {i}", "en" if i % 9 else "de", "s", i) for i in range(1, 1200)]
    table = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], KIND)
    made = m.build(table)
    for r in m.proofs(made, paths=True).collect()[::37]:
        node = r.leaf
        for step in r.path:
            node = digest(step.before + node + step.after)
        assert node == made.root == r.folded_root and r.verified
        assert r.proof_sha256 == digest("".join(s.before + s.after for s in r.path))


def test_one_row_and_none(spark):
    row = (1, "Only", None, None, None)
    have, made = got(spark, [row])
    assert have == brute([row]) and made.root == leaf(row, "Only")
    have, made = got(spark, [])
    assert have == [] and made.root is None
