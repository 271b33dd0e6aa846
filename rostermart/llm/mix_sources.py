"""Mixing sources to target weights: fixed-length blocks, multinomial shards, permuted indices.

1. The words of a source's documents, in the order of a hash, form one stream that
   is packed into blocks of ``block_words``, in a small source of as many fewer as
   make it LEAST_BLOCKS blocks (one word each at the least), so that rounding to
   whole blocks leaves it near its target too; a block names its documents' word
   ranges. Places in the stream come from sums over hash buckets, so that no
   source goes through one task.
2. Each output shard draws how many of its slots each source gets (multinomial,
   seeded by the shard). Over all shards the draws miss a source's number of slots
   by a little; the surplus slots of some sources are handed to those that lack
   as many, so that every source gets its number exactly.
3. Slot number j of a source in pass ``j div blocks`` takes the block at place
   ``j mod blocks`` of a pseudorandom permutation of that pass: every block is
   taken once before any is taken again. Slots and blocks join by index.

Defined cases: a null text has size 0, is never taken and stays in the result; a
null source is the last source; a source without words has target 0; repeated
rows are documents of their own; an empty table gives no rows; other columns are
ignored. The sources' sizes, one row each, go to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostermart.llm.texts import U64, mix, row_key
from rostermart.sources.scratch import saved

BUCKETS = 1024
LEAST_BLOCKS = 64
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Source:
    number: int
    name: str | None
    size: int
    target: float
    block_words: int
    blocks: int
    slots: int


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """``share`` of all sizes dealt by weight; nobody above ``most`` times its size, the excess dealt again among the others."""
    out, left, open_ = [0.0] * len(sizes), share * sum(sizes), set(range(len(sizes)))
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if each * weights[i] > most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = each * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ -= full
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0 .. n - 1: four Feistel rounds over the next even number of bits, walked until inside."""
    n, index, key = n.astype(U64), index.astype(U64), key.astype(U64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2).astype(np.float64))) + 1) // 2).astype(U64)
    half += (n > (U64(1) << (U64(2) * half))).astype(U64)
    low = (U64(1) << half) - U64(1)
    out, todo = index.copy(), np.arange(len(index))
    while len(todo):
        a, b, h, m = out[todo] >> half[todo], out[todo] & low[todo], half[todo], low[todo]
        for r in range(4):
            a, b = b, a ^ (mix(b * U64(4) + U64(r) + mix(key[todo])) & m)
        out[todo] = (a << h) | b
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


@dataclass
class Mix:
    """documents: doc_id, key, source_no, size, start (place in its source's stream); slots: shard, slot, source_no, pass, block."""

    documents: DataFrame
    sources: list[Source]
    slots: DataFrame

    def pieces(self) -> DataFrame:
        """source_no, block, key, start, first (word of the document), words."""
        spark, size = self.documents.sparkSession, F.col("block_words")
        lengths = F.broadcast(spark.createDataFrame([(s.number, s.block_words) for s in self.sources], "source_no int, block_words long"))
        docs = self.documents.where("size > 0").join(lengths, "source_no")
        last = F.col("start") + F.col("size") - 1
        cut = docs.select("*", F.explode(F.sequence(F.floor(F.col("start") / size).cast("long"), F.floor(last / size).cast("long"))).alias("block"))
        first = F.greatest("start", F.col("block") * size)
        return cut.select("source_no", "block", "key", "start", (first - F.col("start")).alias("first"),
                          (F.least(last + 1, (F.col("block") + 1) * size) - first).alias("words"))

    def spans(self) -> DataFrame:
        """The mix: shard, slot, source_no, block and each word range in it (key, start, first, words)."""
        return self.slots.join(self.pieces(), ["source_no", "block"])

    def texts(self, documents: DataFrame) -> DataFrame:
        """shard, slot, text: the blocks' words, joined by blanks. ``documents`` are those that were mixed."""
        words = documents.select(_key(), F.regexp_extract_all("text", F.lit(f"({WORD})")).alias("all")).dropDuplicates(["key"])
        said = self.spans().join(words, "key").select(
            "shard", "slot", F.struct("start", F.slice("all", F.col("first").cast("int") + 1, F.col("words").cast("int")).alias("said")).alias("part"))
        return said.groupBy("shard", "slot").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
            "shard", "slot", F.array_join(F.flatten("parts.said"), " ").alias("text"))


def _key():
    return row_key(F.col("doc_id"), F.col("text")).alias("key")


def _placed(documents: DataFrame) -> tuple[DataFrame, list[tuple[str | None, int]]]:
    """Documents with their place in their source's stream, and the sources in order with their sizes."""
    sized = saved(documents.select("doc_id", F.col("source").cast("string").alias("source"),
                                   F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), _key()), "sized")
    sums = saved(sized.groupBy("source", F.pmod("key", F.lit(BUCKETS)).alias("bucket")).agg(F.sum("size").alias("size")), "sums")
    sizes = sorted(((r.source, r.size) for r in sums.groupBy("source").agg(F.sum("size").alias("size")).collect()),
                   key=lambda x: (x[0] is None, x[0] or ""))
    spark = documents.sparkSession
    numbers = F.broadcast(spark.createDataFrame([(name, i) for i, (name, _) in enumerate(sizes)], "name string, source_no int"))
    before = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.join(numbers, F.col("source").eqNullSafe(F.col("name"))).select(
        "source_no", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    numbered = sized.join(numbers, F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "key", "size", "source_no", F.pmod("key", F.lit(BUCKETS)).alias("bucket"))
    own = numbered.withColumn("own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = own.join(base, ["source_no", "bucket"]).select("doc_id", "key", "size", "source_no", (F.col("base") + F.col("own")).alias("start"))
    return saved(placed, "placed"), sizes


def _draws(spark, sources: list[Source], shards: int, shard_slots: int, seed: int) -> DataFrame:
    """shard, source_no, lo, hi: the slot numbers of its source that each shard got."""
    slots = np.array([s.slots for s in sources])
    chance, total = slots / slots.sum(), int(slots.sum())

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            got = np.array([np.random.default_rng([seed, int(k)]).multinomial(min(shard_slots, total - int(k) * shard_slots), chance)
                            for k in ids]).reshape(len(ids), len(chance))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, len(chance))), pa.array(np.tile(np.arange(len(chance), dtype=np.int32), len(ids))),
                                              pa.array(got.reshape(-1))], names=["shard", "source_no", "n"])

    counts = saved(spark.range(shards).mapInArrow(draw, "shard long, source_no int, n long"), "draws")
    drawn = np.zeros(len(sources), np.int64)
    for r in counts.groupBy("source_no").agg(F.sum("n").alias("n")).collect():
        drawn[r.source_no] = r.n
    # ranges of drawn slot numbers: those a source keeps, and those that it hands to another
    ranges = [(i, 0, int(min(drawn[i], slots[i])), i, 0) for i in range(len(sources))]
    giving = [[i, int(slots[i]), int(drawn[i])] for i in range(len(sources)) if drawn[i] > slots[i]]
    taking = [[i, int(drawn[i]), int(slots[i])] for i in range(len(sources)) if drawn[i] < slots[i]]
    while giving and taking:
        g, t = giving[-1], taking[-1]
        n = min(g[2] - g[1], t[2] - t[1])
        ranges.append((g[0], g[1], g[1] + n, t[0], t[1]))
        g[1], t[1] = g[1] + n, t[1] + n
        if g[1] == g[2]:
            giving.pop()
        if t[1] == t[2]:
            taking.pop()
    dealt = F.broadcast(spark.createDataFrame(ranges, "source_no int, r_lo long, r_hi long, to_no int, to_lo long"))
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    lo = counts.withColumn("lo", F.coalesce(F.sum("n").over(before), F.lit(0))).where("n > 0")
    a, b = F.greatest("lo", "r_lo"), F.least(F.col("lo") + F.col("n"), F.col("r_hi"))
    return lo.join(dealt, "source_no").where(a < b).select(
        "shard", F.col("to_no").alias("source_no"), (F.col("to_lo") + a - F.col("r_lo")).alias("lo"), (F.col("to_lo") + b - F.col("r_lo")).alias("hi"))


def mix_sources(documents: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
                block_words: int = 256, shard_slots: int = 4096, seed: int = 11) -> Mix:
    """Weights go to the sources in order, again and again."""
    spark = documents.sparkSession
    placed, sizes = _placed(documents)
    goals = targets([n for _, n in sizes], [weights[i % len(weights)] for i in range(len(sizes))], share, most)
    sources = []
    for i, ((name, size), goal) in enumerate(zip(sizes, goals, strict=True)):
        words = max(1, min(block_words, size // LEAST_BLOCKS))
        blocks = -(-size // words)
        sources.append(Source(i, name, size, goal, words, blocks, round(goal * blocks / size) if size else 0))
    blocks, total = np.array([max(s.blocks, 1) for s in sources], np.int64), sum(s.slots for s in sources)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, j = np.asarray(batch.column("source_no")), np.asarray(batch.column("j"))
            n = blocks[source]
            turn, place = j // n, j % n
            key = mix(np.uint64(seed) + (source.astype(U64) << U64(32)) + turn.astype(U64))
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("slot"), batch.column("source_no"), pa.array(turn),
                                              pa.array(permuted(place, n, key))], names=["shard", "slot", "source_no", "pass", "block"])

    kinds = "shard long, slot string, source_no int, pass long, block long"
    if not total:
        return Mix(placed, sources, spark.createDataFrame([], kinds))
    ranges = _draws(spark, sources, -(-total // shard_slots), shard_slots, seed)
    each = ranges.select("shard", "source_no", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)).alias("j"))
    named = each.select("shard", F.concat_ws("-", "source_no", "j").alias("slot"), "source_no", "j")
    return Mix(placed, sources, named.mapInArrow(deal, kinds))


def taken(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken of each document."""
    spark = mixed.documents.sparkSession
    uses = mixed.slots.groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    words = mixed.pieces().join(uses, ["source_no", "block"]).groupBy("source_no", "start").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
    of = F.broadcast(spark.createDataFrame([(s.number, s.size, float(s.target)) for s in mixed.sources], "source_no int, source_size long, target double"))
    docs = mixed.documents.join(of, "source_no")
    full = docs.where("size > 0").join(words, ["source_no", "start"], "left")
    columns = ["doc_id", "size", "source_size", "target"]
    return full.select(*columns, F.coalesce("taken", F.lit(0)).cast("long").alias("taken")).unionByName(
        docs.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken")))
