"""LM scoring by context-tree weighting over bytes, learned from the corpus itself.

A byte is eight binary decisions. Each decision has a node for every context of 0
to DEPTH preceding bytes, with a Krichevsky-Trofimov estimate from its counts.
Weighting mixes all depths: a node's block probability is half its own estimate
and half the product of its children's, and a prediction blends each node's
estimate with that of the next deeper context by the odds of the two. Contexts
that were never learned from are not part of the tree. Texts begin after DEPTH
marks and end with one mark, so that a text's probability includes its end.

How it is spread:

1. Documents belong to blocks (file splits, divided by hash to at most
   ``block_bytes`` of text). A block gives its distinct strings of DEPTH + 1 bytes
   and its distinct words, with their counts in documents learned from. They
   travel packed: one row for each block and part, parts being hashes of the keys.
2. A part sums its counts over the blocks. Contexts that share their last two bytes
   form subtrees, worked out side by side; only the 256 * 255 nodes of one byte of
   context and the 255 of none meet on the driver, a bound that no input changes.
3. The logarithm of each string's last byte, and each word's count, go back part by
   part to the blocks that hold it and meet the block's texts.

Learned from are documents whose crc32(doc_id as text) mod ``held_out`` is not 0.

Defined cases: null texts are empty; an empty text has its end mark only; null
ids count as empty text and are learned from or not by that; repeated rows count
as often as they are there and get equal scores; with nothing learned, every
decision has probability one half; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.llm.texts import LOWER, SPACED, U64, Slice, find_words, hash_words, held_out_expr, slices
from rostermart.llm.tidy import release, tidy
from rostermart.sources.scratch import saved

DEPTH = 5
MARK = 0xFF
STRING, WORD = 0, 1
END_WORD = U64(0x5851F42D4C957F2D)
MERGE_AT = 1 << 20
SLICE = 1 << 19
PART_BYTES = 64 << 20


def strings_of(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The key of every byte and end mark with its context, and where each text's begin.

    A key holds the context's bytes, nearest first, then the byte itself.
    """
    n, sizes = len(part.offsets) - 1, np.diff(part.offsets)
    buffer = np.full(len(part.data) + DEPTH * (n + 1), MARK, np.uint8)
    buffer[np.arange(len(part.data)) + np.repeat(DEPTH * np.arange(1, n + 1), sizes)] = LOWER[part.data]
    wanted = np.ones(len(buffer) - DEPTH, bool)
    ends = part.offsets[1:] + DEPTH * np.arange(n)
    wanted[(ends[:, None] + np.arange(1, DEPTH)).reshape(-1)] = False
    key = np.zeros(len(wanted), U64)
    for back in range(1, DEPTH + 1):
        key |= buffer[DEPTH - back:len(buffer) - back].astype(U64) << U64(8 * (DEPTH + 1 - back))
    key |= buffer[DEPTH:]
    return key[wanted], part.offsets + np.arange(n + 1)


class Counts:
    """Distinct keys with counts; merged whenever many have come together."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0
        self.limit = MERGE_AT

    def add(self, keys: np.ndarray, weights: np.ndarray) -> None:
        """Each key counts ``weights`` (0 or 1); one of weight 0 is kept with count 0."""
        for w in (0, 1):
            some = np.sort(keys[weights == w])
            if len(some):
                first = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]]))
                self.put(some[first], w * np.diff(np.append(first, len(some))))

    def put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > self.limit:
            self.merge()
            self.limit = max(MERGE_AT, 2 * self.held)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > 1:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.keys, self.counts = [keys[first]], [np.add.reduceat(counts[order], first)]
            self.held = len(first)
        return (self.keys[0], self.counts[0]) if self.keys else (np.zeros(0, U64), np.zeros(0, np.int64))


def words_of(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, each text closed by the end word, and where each text's begin."""
    found = find_words(part, SPACED)
    first = found.first + np.arange(len(found.first))
    out = np.full(first[-1], END_WORD, U64)
    out[np.arange(len(found.starts)) + found.texts()] = hash_words(part, found)
    return out, first


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys * U64(0xD6E8FEB86659FD93)) >> U64(32)) % U64(parts)


def pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, which compresses well."""
    return np.diff(keys, prepend=U64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(8, -1).T).view(U64).reshape(-1), dtype=U64)


def _needs(blocked: DataFrame, parts: int) -> DataFrame:
    """part, block, kind, keys, n: what each block holds and how often it is learned from, packed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[Counts, Counts]] = {}
        for batch in batches:
            block, learn = np.asarray(batch.column("block")), np.asarray(batch.column("learn"))
            for one in np.unique(block):
                own = np.flatnonzero(block == one)
                counts = held.setdefault(int(one), (Counts(), Counts()))
                for part in slices(batch.column("text") if len(own) == len(block) else batch.column("text").take(pa.array(own)), SLICE):
                    weight = learn[own[part.lo:part.hi]]
                    for kind, of in ((STRING, strings_of), (WORD, words_of)):
                        keys, first = of(part)
                        counts[kind].add(keys, np.repeat(weight, np.diff(first)))
        for one in list(held):
            for kind, counts in enumerate(held.pop(one)):
                keys, n = counts.merge()
                part = part_of(keys, parts)
                order = np.argsort(part, kind="stable")
                keys, n, ends = keys[order], n[order].astype(np.uint32), np.searchsorted(part[order], np.arange(parts + 1))
                for p in range(parts):
                    own = slice(ends[p], ends[p + 1])
                    if ends[p] < ends[p + 1]:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([p], pa.int32()), pa.array([one]), pa.array([kind], pa.int8()), pa.array([pack(keys[own])]), pa.array([n[own].tobytes()])],
                            names=["part", "block", "kind", "keys", "n"])

    return blocked.select("block", F.col("learn").cast("int").alias("learn"), "text").mapInArrow(
        tidy(count), "part int, block long, kind byte, keys binary, n binary")


def _totals(needs: DataFrame) -> DataFrame:
    """part, kind, key, n: every key once, with its count over all blocks."""
    def total(rows: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        kinds = rows["kind"].to_pylist()
        for kind in (STRING, WORD):
            own = [i for i, k in enumerate(kinds) if k == kind]
            sums = Counts()
            for i in own:
                sums.put(unpack(rows["keys"][i].as_py()), np.frombuffer(rows["n"][i].as_py(), np.uint32).astype(np.int64))
            keys, n = sums.merge()
            part = rows["part"][0].as_py()
            out.append(pa.table({"part": pa.array(np.full(len(keys), part, np.int32)), "kind": pa.array(np.full(len(keys), kind, np.int8)),
                                 "key": pa.array(keys.view(np.int64)), "n": pa.array(n.astype(np.int64))}))
        release()
        return pa.concat_tables(out)

    return needs.groupBy("part").applyInArrow(total, "part int, kind byte, key long, n long")


def _answered(needs: DataFrame, values: DataFrame) -> DataFrame:
    """block, kind, keys, found: the value of each key that a block holds, in the order of its packed keys."""
    def answer(rows: pa.Table, known: pa.Table) -> pa.Table:
        kind, key, value = (known[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("kind", "key", "value"))
        tables = []
        for k in (STRING, WORD):
            own = kind == k
            order = np.argsort(key[own].view(U64))
            tables.append((key[own].view(U64)[order], value[own][order]))
        found = []
        for k, packed in zip(rows["kind"].to_pylist(), rows["keys"].to_pylist(), strict=True):
            keys, of = tables[k]
            found.append(of[np.searchsorted(keys, unpack(packed))].astype(np.float32 if k == STRING else np.float64).tobytes())
        release()
        return pa.table({"block": rows["block"], "kind": rows["kind"], "keys": rows["keys"], "found": pa.array(found, pa.binary())})

    return needs.drop("n").groupBy("part").cogroup(values.groupBy("part")).applyInArrow(answer, "block long, kind byte, keys binary, found binary")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after raising the argument by eight."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(x * (x + 1) * (x + 2) * (x + 3)) - np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """The natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - np.log(np.pi)


@dataclass
class Level:
    """The nodes of one depth and one of the eight decisions."""

    nodes: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    odds: np.ndarray
    block: np.ndarray
    at: np.ndarray


@dataclass
class Top:
    """Counts and log odds of the nodes of contexts of one byte and of none, by context and decision node."""

    n0: np.ndarray
    n1: np.ndarray
    odds: np.ndarray

    @classmethod
    def of(cls, n0: np.ndarray, n1: np.ndarray, below: np.ndarray) -> Top:
        """From the sums over contexts of two bytes; row 256 is the empty context."""
        own = kt(n0, n1)
        block = np.logaddexp(own, below) - np.log(2)
        all0, all1, all_below = n0.sum(0), n1.sum(0), block.sum(0)
        return cls(np.vstack([n0, all0]), np.vstack([n1, all1]), np.vstack([own - below, kt(all0, all1) - all_below]))


def _levels(keys: np.ndarray, n: np.ndarray, decision: int) -> list[Level]:
    """Depths DEPTH to 2 for one decision (0 to 7) over whole subtrees."""
    byte = (keys & U64(255)).astype(np.int64)
    bit = (byte >> (7 - decision)) & 1
    node_in_byte = ((1 << decision) | (byte >> (8 - decision))).astype(U64)
    out: list[Level] = []
    for depth in range(DEPTH, 1, -1):
        context = keys >> U64(8 * (DEPTH + 1 - depth))
        nodes, at = np.unique((context << U64(8)) | node_in_byte, return_inverse=True)
        n1 = np.bincount(at, n * bit, minlength=len(nodes))
        n0 = np.bincount(at, n * (1 - bit), minlength=len(nodes))
        own = kt(n0, n1)
        if out:
            child = out[-1]
            parent = ((child.nodes >> U64(16)) << U64(8)) | (child.nodes & U64(255))
            below = np.bincount(np.searchsorted(nodes, parent), child.block, minlength=len(nodes))
            out.append(Level(nodes, n0, n1, own - below, np.logaddexp(own, below) - np.log(2), at))
        else:
            out.append(Level(nodes, n0, n1, np.full(len(nodes), np.inf), own, at))
    return out


def _blend(p: np.ndarray, known: np.ndarray, n: np.ndarray, hits: np.ndarray, odds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One depth further up: the first node with counts stands alone, later ones are weighted against what lies below."""
    own = (hits + 0.5) / (n + 1)
    weight = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    there = n > 0
    return np.where(there & known, weight * own + (1 - weight) * p, np.where(there, own, p)), known | there


def log10_of(keys: np.ndarray, n: np.ndarray, top: Top) -> np.ndarray:
    """The log10 probability of each key's last byte after its context."""
    total = np.zeros(len(keys))
    byte = (keys & U64(255)).astype(np.int64)
    last = (keys >> U64(8 * DEPTH)).astype(np.int64)
    for decision in range(8):
        one = ((byte >> (7 - decision)) & 1).astype(bool)
        p, known = np.full(len(keys), 0.5), np.zeros(len(keys), bool)
        for level in _levels(keys, n, decision):
            n0, n1 = level.n0[level.at], level.n1[level.at]
            p, known = _blend(p, known, n0 + n1, np.where(one, n1, n0), level.odds[level.at])
        node = (1 << decision) | (byte >> (8 - decision))
        for context in (last, np.full(len(keys), 256)):
            n0, n1 = top.n0[context, node], top.n1[context, node]
            p, known = _blend(p, known, n0 + n1, np.where(one, n1, n0), top.odds[context, node])
        total += np.log10(p)
    return total


def _whole(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    parts = [(np.asarray(b.column("key")), np.asarray(b.column("n"))) for b in batches if b.num_rows]
    if not parts:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    return keys.view(U64), n


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """last, node, n0, n1, below: what the subtrees of a partition add to the nodes of one byte of context."""
    keys, n = _whole(batches)
    for decision in range(8 if len(keys) else 0):
        level = _levels(keys, n, decision)[-1]
        slot = ((level.nodes >> U64(16)) << U64(8) | (level.nodes & U64(255))).astype(np.int64)
        slots, at = np.unique(slot, return_inverse=True)
        sums = [np.bincount(at, v, minlength=len(slots)) for v in (level.n0, level.n1, level.block)]
        yield pa.RecordBatch.from_arrays([pa.array(slots), *map(pa.array, sums)], names=["slot", "n0", "n1", "below"])


def learn(counts: DataFrame, parts: int) -> DataFrame:
    """part, key, value: the log10 of every string's last byte; ``counts`` (key, n) has each string once, n = 0 if not learned from."""
    together = counts.repartition(F.shiftrightunsigned("key", 8 * (DEPTH - 1)))
    sums = [np.zeros(256 * 256) for _ in range(3)]
    tops = together.mapInArrow(tidy(_tops), "slot long, n0 double, n1 double, below double").groupBy("slot").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below")).toPandas()
    for name, into in zip(("n0", "n1", "below"), sums, strict=True):
        into[tops["slot"].to_numpy()] = tops[name].to_numpy()
    top = Top.of(*(s.reshape(256, 256) for s in sums))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = _whole(batches)
        if len(keys):
            yield pa.RecordBatch.from_arrays([pa.array(part_of(keys, parts).astype(np.int32)), pa.array(keys.view(np.int64)), pa.array(log10_of(keys, n, top))],
                                             names=["part", "key", "value"])

    return together.mapInArrow(tidy(predict), "part int, key long, value double")


class Lookup:
    """An open hash table over distinct keys, filled and asked with whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.row = np.full(1 << self.bits, -1, np.int32)
        self.keys, self.values = keys, values
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.row[slot[todo]] < 0
            self.row[slot[todo[free]]] = todo[free]
            todo = todo[self.row[slot[todo]] != todo]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        self.table = np.where(self.row >= 0, keys[self.row] if len(keys) else U64(0), U64(0))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        row = self.row[slot]
        todo = np.flatnonzero((self.table[slot] != keys) | (row < 0))
        while len(todo):
            if (row[todo] < 0).any():
                raise ValueError("a text of this block was not there when the block was counted")
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            row[todo] = self.row[slot[todo]]
            todo = todo[(self.table[slot[todo]] != keys[todo]) | (row[todo] < 0)]
        return self.values[row]


def _blocked(documents: DataFrame, held_out: int, block_bytes: int) -> tuple[DataFrame, int]:
    """doc_id, text, block, held_out, learn; and the bytes of all texts."""
    text = F.coalesce("text", F.lit(""))
    split = F.xxhash64(F.input_file_name(), F.input_file_block_start())
    docs = documents.select("doc_id", text.alias("text"), split.alias("split"))
    sizes = docs.groupBy("split").agg(F.sum(F.octet_length("text") + 1).alias("bytes")).agg(F.max("bytes").alias("most"), F.sum("bytes").alias("all")).first()
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-(sizes["most"] or 0) // block_bytes))))
    out = held_out_expr(F.col("doc_id"), held_out)
    return docs.select("doc_id", "text", F.xxhash64("split", share).alias("block"), out.alias("held_out"), (~out).alias("learn")), sizes["all"] or 0


def score(documents: DataFrame, held_out: int = 10, block_bytes: int = 32 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    blocked, size = _blocked(documents, held_out, block_bytes)
    parts = max(1, -(-size // PART_BYTES))
    needs = saved(_needs(blocked, parts), "needs")
    counts = saved(_totals(needs), "counts")
    words = counts.where(F.col("kind") == WORD)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    learned = learn(counts.where(F.col("kind") == STRING).select("key", "n"), parts)
    values = learned.select("part", F.lit(STRING).cast("byte").alias("kind"), "key", "value").unionByName(
        words.select("part", "kind", "key", F.col("n").cast("double").alias("value")))
    tables = _answered(needs, values)
    least = np.log10(total.n + 0.1 * (total.v + 1))

    def run(docs: pa.Table, table: pa.Table) -> pa.Table:
        find = []
        for k, form in ((STRING, np.float32), (WORD, np.float64)):
            rows = table.filter(pc.equal(table["kind"], k))
            keys = [unpack(p) for p in rows["keys"].to_pylist()]
            values = [np.frombuffer(p, form) for p in rows["found"].to_pylist()]
            find.append(Lookup(np.concatenate([np.zeros(0, U64), *keys]), np.concatenate([np.zeros(0, form), *values])))
            del rows, keys, values
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        for part in slices(docs["text"], SLICE):
            keys, first = words_of(part)
            c = find[WORD](keys)
            strings, begin = strings_of(part)
            for into, what in zip(out, (np.diff(first), np.add.reduceat((c > 0).astype(np.int64), first[:-1]),
                                        np.add.reduceat(np.log10(c + 0.1) - least, first[:-1]),
                                        np.add.reduceat(find[STRING](strings).astype(np.float64), begin[:-1]), np.diff(begin)), strict=True):
                into.append(what)
        n, known, base, scored, size = (np.concatenate(x) if x else np.zeros(0) for x in out)
        find.clear()
        release()
        return pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(n, pa.int64()), "n_known": pa.array(known, pa.int64()),
                         "base_score": pa.array(base, pa.float64()), "score": pa.array(scored, pa.float64()), "n_bytes": pa.array(size, pa.int64())})

    kind = dict(documents.dtypes)["doc_id"]
    texts = blocked.select("doc_id", "held_out", "text", "block")
    scored = texts.groupBy("block").cogroup(tables.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total.n).cast("long").alias("train_tokens"), "base_score", "score",
                         "n_bytes", (-F.col("score") / (F.lit(float(np.log10(2))) * F.col("n_bytes"))).alias("bits_per_byte"))
