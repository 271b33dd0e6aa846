"""Merkle manifest of a document table: leaves placed by bitmap ranks, nodes reduced in keyed slot arrays.

Per language a bitmap of doc_ids is kept as its non-empty 64-bit words (merged
from the tasks with ``bit_or``) with a popcount directory: the number of leaves
before each word, summed inside runs of 256 words, then inside runs of runs. A
leaf's coordinate is the count before its word plus the bits below its own, so
no table is sorted. 512 consecutive leaves form a slot array under one key, which one
task reduces by three levels of eight; the array's node is a slot of the next
round. On the way back every array hands its slots the siblings above them.

Defined cases: a null doc_id comes before all others and a null language before
all others; a null field is hashed as ``-``; rows with the same doc_id and
language follow each other by leaf, equal rows are leaves each; an empty table has
no rows and no root. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermart.llm.tidy import tidy
from rostermart.operators.ordering import positions
from rostermart.sources.scratch import saved

RUN = 8
STEPS = 3
SLOT_BITS = 9  # RUN ** STEPS slots of an array
FAN_BITS = 8
#: So many rows of a directory's highest level, for each group, are summed in one window.
TOP = 4096
#: The word of a null doc_id: before the words of all longs.
NO_ID = -(1 << 57) - 1
#: Copies of one row that are dealt out together.
COPIES = 4096
PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
PATH_SQL = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """How a value enters its leaf: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    """The digest (binary) of a documents row whose text reads ``text``."""
    parts = [*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text]
    return F.unhex(F.sha2(F.concat(*[field(p) for p in parts]).cast("binary"), 256))


def counts_before(counts: DataFrame, group: list[str]) -> DataFrame:
    """``counts`` (group, slot, n) with ``before``: the sum of n over the smaller slots of the group.

    A directory of fixed fan-out: sums inside runs of 256 slot numbers, and above
    them the same for the runs, until the runs of each group are few.
    """
    runs = saved(counts.groupBy(*group, F.shiftright("slot", FAN_BITS).alias("run")).agg(F.sum("n").alias("n")), "manifest-runs")
    widest = runs.groupBy(*group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    over = runs.withColumnRenamed("run", "slot")
    if widest > TOP:
        over = counts_before(over, group)
    else:
        whole = Window.partitionBy(*group).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        over = over.withColumn("before", F.coalesce(F.sum("n").over(whole), F.lit(0)))
    over = over.select(*group, F.col("slot").alias("run"), F.col("before").alias("base"))
    inside = Window.partitionBy(*group, "run").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (counts.withColumn("run", F.shiftright("slot", FAN_BITS)).withColumn("near", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(over, [*group, "run"]).withColumn("before", F.col("base") + F.col("near")).drop("run", "near", "base"))


def _repeats(leaves: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For words with more rows than bits: their ids that repeat (k, slot, bit, more), and those ids' leaves with ``nth`` among them."""
    crowded = words.where("n > bit_count(mask)").select("k", "slot")
    ids = saved(leaves.join(crowded, ["k", "slot"]).groupBy("k", "slot", "bit", "doc_id", "leaf", "claimed").agg(F.count("*").alias("n")), "manifest-copies")
    often = ids.groupBy("k", "slot", "bit").agg(F.sum("n").alias("all")).where("all > 1")
    group = ["k", "word", "bit"]
    # Among the leaves of one id the order is that of their digests: by their first 56 bits through the directory, then by the rest.
    mine = (ids.join(often.drop("all"), ["k", "slot", "bit"]).withColumnRenamed("slot", "word")
            .withColumn("slot", F.conv(F.substring(F.hex("leaf"), 1, 14), 16, 10).cast("long")))
    placed = counts_before(mine.groupBy(*group, "slot").agg(F.sum("n").alias("n")), group).select(*group, "slot", "before")
    same = Window.partitionBy(*group, "slot").orderBy("leaf", "claimed").rowsBetween(Window.unboundedPreceding, -1)
    mine = (mine.withColumn("first", F.coalesce(F.sum("n").over(same), F.lit(0))).join(placed, [*group, "slot"])
            .withColumn("first", F.col("first") + F.col("before")).drop("slot", "before").withColumnRenamed("word", "slot"))
    runs = mine.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))).alias("lo"))
    dealt = runs.repartition("k", "slot", "bit", "leaf", "lo")
    copies = dealt.select("k", "slot", "bit", "doc_id", "leaf", "claimed", F.explode(
        F.sequence(F.col("first") + F.col("lo"), F.col("first") + F.least(F.col("n"), F.col("lo") + COPIES) - 1)).alias("nth"))
    return often.select("k", "slot", "bit", (F.col("all") - 1).alias("more")), copies


def ranked_leaves(documents: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """k (language key), rank (from 0 in its language), doc_id, leaf, claimed (the leaf with the claimed text) of each row."""
    read = documents.select("doc_id", "source", "lang", "n_chars", "text", (F.col("text") if claimed_text is None else claimed_text).alias("said"))
    read = read.withColumn("leaf", leaf_of(F.col("text")))
    claimed = F.when(F.col("said").eqNullSafe(F.col("text")), F.col("leaf")).otherwise(leaf_of(F.col("said")))
    leaves = saved(read.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("k"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.shiftright(F.col("doc_id").cast("long"), 6), F.lit(NO_ID)).alias("slot"),
        F.coalesce(F.col("doc_id").cast("long").bitwiseAND(63), F.lit(0)).cast("int").alias("bit"),
        "leaf", claimed.alias("claimed")), "manifest-leaves")
    words = saved(leaves.groupBy("k", "slot").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"), F.count("*").alias("n")), "manifest-words")
    directory = counts_before(words, ["k"])
    below = F.col("before") + F.expr("bit_count(mask & ~shiftleft(-1L, bit))")
    if words.where("n > bit_count(mask)").isEmpty():
        return leaves.join(directory, ["k", "slot"]).select("k", below.alias("rank"), "doc_id", "leaf", "claimed")
    often, copies = _repeats(leaves, words)
    more = often.groupBy("k", "slot").agg(F.collect_list(F.struct("bit", "more")).alias("repeated"))  # at most 64
    directory = directory.join(more, ["k", "slot"], "left")
    once = leaves.join(often, ["k", "slot", "bit"], "left_anti").withColumn("nth", F.lit(0).cast("long"))
    extra = F.aggregate(F.filter(F.col("repeated"), lambda r: r["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda total, r: total + r["more"])
    both = once.unionByName(copies).join(directory, ["k", "slot"])
    return both.select("k", (below + F.coalesce(extra, F.lit(0)) + F.col("nth")).alias("rank"), "doc_id", "leaf", "claimed")


def _levels(nodes: list[bytes], block: int) -> list[list[bytes]]:
    """The slots of an array (hex digests) and their levels above: to one node, in a later array of its key through all steps."""
    levels = [nodes]
    while len(levels) <= STEPS and (block or len(levels[-1]) > 1):
        last = levels[-1]
        levels.append([sha256(b"".join(last[i:i + RUN])).hexdigest().encode() for i in range(0, len(last), RUN)])
    return levels


def _beside(level: list[bytes], at: int) -> tuple[bytes, bytes]:
    first = at - at % RUN
    return b"".join(level[first:at]), b"".join(level[at + 1:first + RUN])


def _hexed(nodes: list[bytes]) -> list[bytes]:
    return [n.hex().encode() for n in nodes]


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Slot arrays of ``nodes`` (k, rank, node and more), round by round, until every key has one: k, block, slots, node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bytes.fromhex(_levels(_hexed(nodes), block)[-1][0].decode())
                    for nodes, block in zip(_slots(batch), batch.column("block").to_pylist(), strict=True)]
            yield batch.append_column("made", pa.array(made, pa.binary()))

    out = []
    while True:
        slot = F.struct(F.col("rank").bitwiseAND((1 << SLOT_BITS) - 1).alias("place"), *[c for c in nodes.columns if c not in ("k", "rank")])
        arrays = (nodes.select("k", F.shiftright("rank", SLOT_BITS).alias("block"), slot.alias("slot")).groupBy("k", "block")
                  .agg(F.array_sort(F.collect_list("slot")).alias("slots")))
        table = saved(arrays.mapInArrow(tidy(run), f"k string, block long, slots {dict(arrays.dtypes)['slots']}, made binary"), f"manifest-round-{len(out)}")
        out.append(table)
        if table.where("block > 0").isEmpty():
            return out
        nodes = table.select("k", F.col("block").alias("rank"), F.col("made").alias("node"))


def _slots(batch: pa.RecordBatch, name: str = "node") -> list[list]:
    """A field of each row's slots, in order of place."""
    slots = batch.column("slots")
    flat, ends = slots.flatten().field(name).to_pylist(), slots.value_lengths().to_pylist()
    out, lo = [], 0
    for n in ends:
        out.append(flat[lo:lo + n])
        lo += n
    return out


@dataclass
class Manifest:
    """The slot arrays of the leaves and of the languages, each language's subroot and the root (None of no rows)."""

    leaf_rounds: list[DataFrame]
    lang_rounds: list[DataFrame]
    subroots: DataFrame
    root: str | None


def build(documents: DataFrame, claimed_text: Column | None = None) -> Manifest:
    """The manifest of ``documents``; with ``claimed_text``, the leaves that a reader with these texts would make lie beside it."""
    leaves = ranked_leaves(documents, claimed_text)
    rounds = _rounds(leaves.withColumnRenamed("leaf", "node"))
    subroots = saved(positions(rounds[-1].select("k", "made"), ["k"], "rank"), "manifest-subroots")
    if subroots.isEmpty():
        return Manifest(rounds, [], subroots, None)
    langs = _rounds(subroots.select(F.lit("").alias("k"), "rank", F.col("made").alias("node")))
    return Manifest(rounds, langs, subroots, langs[-1].first()["made"].hex())


def _handed_down(arrays: DataFrame, above: DataFrame) -> DataFrame:
    """k, rank, path of the slots of ``arrays``; ``above`` has the path (and subroot) of each array: k, block, path, subroot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {"k": [], "rank": [], "path": [], "subroot": []}
            for k, block, nodes, path, subroot in zip(*(batch.column(c).to_pylist() for c in ("k", "block")), _slots(batch),
                                                      *(batch.column(c).to_pylist() for c in ("path", "subroot")), strict=True):
                levels = _levels(_hexed(nodes), block)
                for at in range(len(nodes)):
                    own = [_beside(level, at // RUN ** j) for j, level in enumerate(levels[:-1])]
                    rows["k"].append(k)
                    rows["rank"].append((block << SLOT_BITS) + at)
                    rows["path"].append([{"before": b.decode(), "after": a.decode()} for b, a in own] + path)
                    rows["subroot"].append(subroot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["k"], pa.string()), pa.array(rows["rank"], pa.int64()), pa.array(rows["path"], PATH), pa.array(rows["subroot"], pa.string())],
                names=["k", "rank", "path", "subroot"])

    return arrays.join(above, ["k", "block"]).select("k", "block", "slots", "path", "subroot").mapInArrow(
        tidy(run), f"k string, rank long, path {PATH_SQL}, subroot string")


def _as_above(slots: DataFrame) -> DataFrame:
    return slots.select("k", F.col("rank").alias("block"), "path", "subroot")


def proofs(manifest: Manifest, paths: bool = False) -> DataFrame:
    """Each row's doc_id, lang, rank, leaf, subroot, root, proof_sha256, folded_root and verified; with ``paths`` also its path.

    A path holds, level by level, the siblings before and after the node;
    ``folded_root`` is made from the claimed leaf (the leaf itself without
    claims) and the path, and ``verified`` says whether it is the root.
    """
    spark, root = manifest.subroots.sparkSession, manifest.root
    above = spark.range(1).select(F.lit("").alias("k"), F.lit(0).cast("long").alias("block"), F.array().cast(PATH_SQL).alias("path"), F.lit("").alias("subroot"))
    for arrays in reversed(manifest.lang_rounds):
        above = saved(_as_above(_handed_down(arrays, above)), "manifest-paths")
    langs = above.select(F.col("block").alias("rank"), "path")
    above = manifest.subroots.join(langs, "rank").select("k", F.lit(0).cast("long").alias("block"), "path", F.lower(F.hex("made")).alias("subroot"))
    for arrays in reversed(manifest.leaf_rounds[1:]):
        above = saved(_as_above(_handed_down(arrays, above)), "manifest-paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = zip(*(batch.column(c).to_pylist() for c in ("k", "block", "path", "subroot")),
                         *(_slots(batch, c) for c in ("node", "doc_id", "claimed")), strict=True)
            for k, block, path, subroot, nodes, ids, claims in fields:
                levels = _levels(_hexed(nodes), block)
                upper = [(p["before"].encode(), p["after"].encode()) for p in path]
                rest = [b"".join(b + a for b, a in upper)]  # the siblings above each node of a level, from the top level down
                beside = []
                for j in range(len(levels) - 2, -1, -1):
                    here = [_beside(levels[j], at) for at in range(len(levels[j]))]
                    rest = [b + a + rest[at // RUN] for at, (b, a) in enumerate(here)]
                    beside.insert(0, here)
                folded, whole = [], []
                for at, claim in enumerate(claims):
                    node, own = levels[0][at] if claim is None else claim.hex().encode(), at
                    for here in beside:
                        b, a = here[own]
                        node, own = sha256(b + node + a).hexdigest().encode(), own // RUN
                    for b, a in upper:
                        node = sha256(b + node + a).hexdigest().encode()
                    folded.append(node.decode())
                    if paths:
                        mine = [here[at // RUN ** j] for j, here in enumerate(beside)] + upper
                        whole.append([{"before": b.decode(), "after": a.decode()} for b, a in mine])
                n = len(nodes)
                columns = [pa.array(ids, pa.int64()), pa.array([k[1:] if k else None] * n, pa.string()),
                           pa.array(range(block << SLOT_BITS, (block << SLOT_BITS) + n), pa.int64()), pa.array([x.decode() for x in levels[0]], pa.string()),
                           pa.array([subroot] * n, pa.string()), pa.array([root] * n, pa.string()),
                           pa.array([sha256(r).hexdigest() for r in rest], pa.string()), pa.array(folded, pa.string()),
                           pa.array([f == root for f in folded], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(whole, PATH)] if paths else []), names=names)

    kind = "doc_id long, lang string, rank long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    kind += f", path {PATH_SQL}" if paths else ""
    names = [c.split()[0] for c in kind.split(", ")]
    arrays = manifest.leaf_rounds[0].join(above, ["k", "block"]).select("k", "block", "slots", "path", "subroot")
    return arrays.mapInArrow(tidy(run), kind)
