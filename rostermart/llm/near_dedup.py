"""Near-duplicates: SuperMinHash signatures, banding, verification on full sets, grouping by union-find.

1. Every text becomes its set of distinct shingles. Rows with equal sets are one
   class; only classes go on, so exact copies cost nothing more.
2. SuperMinHash: each shingle deals one random permutation of the signature's
   places; round j offers its j-th place the value ``j + random``. A text is done
   as soon as all its places hold values below the next round's, which for long
   texts is after one or two rounds.
3. Bands of ``rows`` signature values put classes into buckets. Each bucket sends
   pairs with one pivot, not all pairs. Pairs whose sizes or signatures cannot
   reach the threshold go (signature agreement more than seven deviations below
   it), and those whose parities, a bit for each of 1,024 hashes, differ in more
   bits than linked sets differ in shingles; the others are compared on their full
   sets. Links form components.
4. Classes that met the same pivot and are in several components are joined by what
   they differ in from it. D(x) is the symmetric difference of x and the pivot; that
   of x and y has |D(x)| + |D(y)| - 2 |D(x) and D(y)| shingles. If x and y reach the
   threshold and one of them is not linked to the pivot, D(x) and D(y) therefore
   share a stated least number of shingles, always one at least; that of a class
   linked to the pivot is more than about half of its own. So each class
   offers the rarest shingles of D(x), as many as that number needs (prefix filter),
   and pairs meet on those, if what follows in both has room for all that this
   pair has to share (positional filter), under bounds on sizes and differences, and
   if their parities do not rule them out. What a whole group shares, the pivot's own
   shingles included, is in nobody's prefix: texts that are alike and not linked make
   few pairs.
5. Of the pairs that meet between the same two components, the one whose parities
   leave most room is confirmed on full sets first. What this joins up needs no
   other pair, so that the links inside a group of near copies, whose number grows
   with its square, are not all compared; every pair between components that are
   still apart is. A pair is sent once, whatever bands and pivots it shares (and at
   most once in the first round).

A link is missed only if no band agrees: at similarity 0.85, with 25 bands of 5,
that has a probability of 4e-7; at 0.8 of 5e-5.

Defined cases: null, empty and wordless texts have an empty set and are linked
with nothing; fewer words than a shingle make the whole sequence one shingle;
rows that repeat a doc_id with other texts are documents of their own; a null
doc_id never names a component unless all its members are null; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermart.llm.bitmaps import bitmap, sifted
from rostermart.llm.texts import SPACED, U64, find_words, hash_runs, hash_words, mix, row_key, run_starts, slices
from rostermart.llm.tidy import tidy
from rostermart.sources.scratch import saved

PLACES = 128
BANDS, BAND_ROWS = 25, 5
USED = BANDS * BAND_ROWS
#: Bits of a set's parities; a multiple of 32.
PARITIES = 1024
#: Bits of the parities that prefixes carry; a multiple of 64 that divides PARITIES.
FOLDED = 512
WIDTH = USED + PARITIES // 32


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: the first row, all sorted distinct shingle hashes on end, and where each row's begin."""
    for part in slices(column):
        found = find_words(part, SPACED)
        words = hash_words(part, found)
        starts = run_starts(found, k)
        runs = hash_runs(words, k)[starts] if len(starts) else np.zeros(0, U64)
        text_of = np.searchsorted(found.first, starts, "right") - 1
        first = np.searchsorted(text_of, np.arange(len(found.counts) + 1))
        sets = []
        for i, n in enumerate(found.counts):
            if n >= k:
                own = np.sort(runs[first[i]:first[i + 1]])
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif n:
                own = hash_runs(words[found.first[i]:found.first[i] + n], int(n))
            else:
                own = np.zeros(0, U64)
            sets.append(own)
        sizes = np.array([len(s) for s in sets], np.int64)
        yield part.lo, np.concatenate(sets) if sets else np.zeros(0, U64), np.concatenate([[0], np.cumsum(sizes)])


def super_minhash(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A signature of PLACES 64-bit numbers for each set: the round in the high half, the random part in the low one."""
    n = len(first) - 1
    none = np.iinfo(np.uint64).max
    out = np.full((n, PLACES), none, U64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(n), np.diff(first))
    live = np.arange(len(values))
    decks: np.ndarray | None = None
    for j in range(PLACES):
        own = owner[live]
        draw = mix(values[live] + U64(0x632BE59BD9B4E019 * (j + 1) % (1 << 64)))
        swap = j + ((draw >> U64(40)) % U64(PLACES - j)).astype(np.int64)
        if decks is None:
            place = swap
        else:
            at = np.arange(len(live))
            place = decks[at, swap].astype(np.int64)
            decks[at, swap] = decks[:, j]
            decks[at, j] = place
        np.minimum.at(flat, own * PLACES + place, (U64(j) << U64(32)) | (draw & U64(0xFFFFFFFF)))
        open_sets = out.max(1) >= (U64(j + 1) << U64(32))
        stay = open_sets[own]
        if not stay.any():
            break
        if decks is None:  # the first round's swap of all that go on
            decks = np.tile(np.arange(PLACES, dtype=np.uint8), (int(stay.sum()), 1))
            at, first_place = np.arange(len(decks)), place[stay]
            decks[at, first_place] = 0
            decks[:, 0] = first_place
        else:
            decks = decks[stay]
        live = live[stay]
    return out


def parities(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set PARITIES bits as 4-byte values: the parity of its members by a hash. Two sets differ in at least as many members as bits."""
    n = len(first) - 1
    at = np.repeat(np.arange(n), np.diff(first)) * PARITIES + (mix(values ^ U64(0x3C3C3C3CC3C3C3C3)) % U64(PARITIES)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=n * PARITIES) & 1).astype(np.uint8).reshape(n, PARITIES), axis=1).view(np.uint32)


def _signed(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, row, n (set size), cls (16 bytes that name the set), sig (WIDTH 4-byte values: the signature and the parities)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, values, first in shingle_sets(batch.column("text"), k):
                n = len(first) - 1
                sums = np.zeros((2, len(values) + 1), U64)
                np.cumsum(mix(values), out=sums[0, 1:])
                np.cumsum(mix(values ^ U64(0xA5A5A5A55A5A5A5A)), out=sums[1, 1:])
                names = np.ascontiguousarray((sums[:, first[1:]] - sums[:, first[:-1]]).T)
                signature = np.hstack([mix(super_minhash(values, first)[:, :USED]).astype(np.uint32), parities(values, first)])
                head = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays(
                    [head.column("doc_id"), head.column("row"), pa.array(np.diff(first)),
                     pa.array([r.tobytes() for r in names], pa.binary()), pa.array([r.tobytes() for r in signature], pa.binary())],
                    names=["doc_id", "row", "n", "cls", "sig"])

    docs = documents.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    return docs.mapInArrow(tidy(sign), f"doc_id {dict(docs.dtypes)['doc_id']}, row long, n long, cls binary, sig binary")


def _plausible(pairs: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b, sig_a, sig_b, most) whose signatures agree in at least ``least`` places and whose parities differ in at most ``most``."""

    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, WIDTH) for c in ("sig_a", "sig_b"))
                odd = np.bitwise_count(a[:, USED:] ^ b[:, USED:]).sum(1, dtype=np.int64)
                near = pa.array(((a[:, :USED] == b[:, :USED]).sum(1) >= least) & (odd <= np.asarray(batch.column("most"))))
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], names=["a", "b"])

    return pairs.mapInArrow(tidy(agree), "a binary, b binary")


def _beside(pairs: DataFrame, texts: DataFrame, group: int = 64) -> DataFrame:
    """a, salt, side, b, text: for the pairs (a, b) the text of ``a`` (side 0) right before those of its partners (side 1).

    The text of ``a`` travels once for every ``group`` partners, that of each
    partner once for each pair; rows of a group arrive in order.
    """
    dealt = saved(pairs.join(pairs.groupBy("a").agg(F.count("*").alias("many")), "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("many") / group)).cast("int").alias("salt")), "dealt")
    heads = dealt.select("a", "salt").distinct().join(texts.withColumnRenamed("cls", "a"), "a").select(
        "a", "salt", F.lit(0).alias("side"), F.col("a").alias("b"), "text")
    members = dealt.join(texts.withColumnRenamed("cls", "b"), "b").select("a", "salt", F.lit(1).alias("side"), "b", "text")
    return heads.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", "side")


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, U64)
        for batch in batches:
            side = np.asarray(batch.column("side"))
            near = np.zeros(batch.num_rows, bool)
            for lo, values, first in shingle_sets(batch.column("text"), k):
                for i in range(len(first) - 1):
                    own = values[first[i]:first[i + 1]]
                    if side[lo + i] == 0:
                        head = own
                    else:
                        at = np.searchsorted(head, own)
                        at[at == len(head)] = 0
                        common = int((head[at] == own).sum()) if len(head) else 0
                        near[lo + i] = 100 * common >= percent * (len(head) + len(own) - common)
            near = pa.array(near)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(near), batch.column("b").filter(near)], names=["a", "b"])

    return _beside(pairs, texts).mapInArrow(tidy(verify), "a binary, b binary")


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one partition: every node but the roots with its root, the smallest node."""
    up: dict[bytes, bytes] = {}

    def root(x: bytes) -> bytes:
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            x, y = root(a), root(b)
            if x != y:
                up[max(x, y)] = min(x, y)
    rooted = [(x, root(x)) for x in up]
    u, v = zip(*[r for r in rooted if r[0] != r[1]], strict=True) if any(x != r for x, r in rooted) else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])


def components(links: DataFrame, task_edges: int = 1 << 18) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``links`` (a, b).

    Tasks of about ``task_edges`` links run union-find on their own. What they leave
    is joined up by alternating large and small stars: in each step every node
    tells its neighbours the smallest node that it knows, until nothing changes.
    """
    named = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = saved(named, "edges")
    parts = max(1, -(-edges.count() // task_edges))
    edges = saved(edges.repartition(parts).mapInArrow(tidy(_forest), "u binary, v binary"), "edges")
    before = None
    while parts > 1:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()
        lows = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lows, "u").select(F.col("v").alias("x"), "u", "low")
        edges = saved(small.select(F.col("x").alias("u"), F.col("low").alias("v")).where("u <> v")
                      .unionByName(lows.select("u", F.col("low").alias("v"))).distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _differences(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """pivot, cls, shingles: for the pairs (a, b) the sorted shingles that only one of the two has."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, U64)
        for batch in batches:
            side = np.asarray(batch.column("side"))
            for lo, values, first in shingle_sets(batch.column("text"), k):
                rows, found = [], []
                for i in range(len(first) - 1):
                    own = values[first[i]:first[i + 1]]
                    if side[lo + i] == 0:
                        head = own
                    else:
                        rows.append(lo + i)
                        found.append(np.setxor1d(head, own, assume_unique=True).view(np.int64))
                at = pa.array(rows, pa.int64())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at), lists], names=["pivot", "cls", "shingles"])

    return _beside(pairs, texts).mapInArrow(tidy(compare), "pivot binary, cls binary, shingles array<long>")


def _most(n: Column, percent: int) -> Column:
    """The largest symmetric difference of two linked sets of ``n`` shingles together."""
    return F.floor((100 - percent) * n / (100 + percent))


def _odd(sig: Column) -> list[Column]:
    """A signature's parities, folded into FOLDED bits, as longs: two sets still differ in at least as many members as bits."""
    longs = [F.conv(F.hex(F.substring(sig, 4 * USED + 8 * i + 1, 8)), 16, -10).cast("long") for i in range(PARITIES // 64)]
    step = FOLDED // 64
    return [reduce(Column.bitwiseXOR, longs[i::step]).alias(f"odd{i}") for i in range(step)]


def _prefix_pairs(members: DataFrame, signatures: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of one pivot's ``members`` (pivot, cls, n, n_pivot, root) in several components that neither their differences from it nor parities rule out.

    a, b, low and high (hashes of their roots), slack (by how many bits their parities stay below the largest difference of linked sets).
    """
    apart = saved(_differences(members.select(F.col("pivot").alias("a"), F.col("cls").alias("b")), texts, k)
                  .withColumn("id", F.monotonically_increasing_id()), "differences")
    odd = [f"odd{i}" for i in range(FOLDED // 64)]
    # Members go by a number of 8 bytes, and roots by a hash.
    sized = saved(members.join(apart.select("pivot", "cls", "id", F.size("shingles").cast("long").alias("d")), ["pivot", "cls"])
                  .join(signatures.select("cls", *_odd(F.col("sig"))), "cls")
                  .select("id", "cls", "n", "n_pivot", "d", F.xxhash64("root").alias("root"), *odd), "sized")
    spread = apart.select("id", "pivot", F.explode("shingles").alias("shingle")).select("id", F.xxhash64("pivot", "shingle").alias("shingle"))
    common = spread.groupBy("shingle").agg(F.count("*").alias("many")).where("many > 1")

    # Shingles that one member alone has come first in its prefix and meet nobody; of the others the rarest follow.
    order = Window.partitionBy("id").orderBy("many", "shingle")
    ranked = (spread.join(common, "shingle").withColumn("no", F.row_number().over(order))
              .withColumn("of", F.count("*").over(Window.partitionBy("id"))).join(sized.drop("cls"), "id")
              .withColumn("at", F.col("d") - F.col("of") + F.col("no")))
    n, d, both = F.col("n"), F.col("d"), 100 + percent
    # One of a pair at least is not linked to the pivot: its difference is above (100 - percent) * (n + n_pivot) / (100 + percent). So linked sets
    # share more than half of (the other's difference + (100 - percent) * (n_pivot - n) / (100 + percent)), of whichever of the two is linked to it.
    half = F.floor((both * d + (100 - percent) * (F.col("n_pivot") - n)) / (2 * both)) + 1
    whole = d - _most(n + F.floor(100 * n / percent), percent)
    least = F.greatest(F.lit(1), F.when(d <= _most(n + F.col("n_pivot"), percent), half).otherwise(whole))
    prefix = saved(ranked.where(F.col("at") <= d - least + 1).select("shingle", "id", "n", "d", "at", "root", *odd), "prefixes")
    x, y = (prefix.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in prefix.columns[1:]]) for side in "xy")
    # The first shingle that two linked sets meet on leaves room for all the others that they have to share.
    room = _most(F.col("n_x") + F.col("n_y"), percent)
    rest = F.least(F.col("d_x") - F.col("at_x"), F.col("d_y") - F.col("at_y")) + 1
    slack = room - sum(F.bit_count(F.col(f"{c}_x").bitwiseXOR(F.col(f"{c}_y"))) for c in odd)
    alike = ((F.col("id_x") < F.col("id_y")) & (F.col("root_x") != F.col("root_y"))
             & (100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")) & (F.abs(F.col("d_x") - F.col("d_y")) <= room)
             & (2 * rest >= F.col("d_x") + F.col("d_y") - room) & (slack >= 0))
    found = x.join(y, "shingle").where(alike).select(
        "id_x", "id_y", F.least("root_x", "root_y").alias("low"), F.greatest("root_x", "root_y").alias("high"), slack.alias("slack")).distinct()
    a, b = (sized.select(F.col("id").alias(f"id_{side}"), F.col("cls").alias(name)) for side, name in (("x", "a"), ("y", "b")))
    return found.join(a, "id_x").join(b, "id_y").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "low", "high", "slack").distinct()


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, row, n_shingles, component_id (smallest doc_id of its component), lead (the row key that stands for it)."""
    signed = saved(_signed(documents, k), "signed")
    classes = saved(signed.where("n > 0").groupBy("cls").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("lead"),
        F.max("n").alias("n"), F.max("sig").alias("sig")).withColumn("row", F.col("lead.row")), "classes")
    least = int(USED * (percent / 100 - 7 * (percent / 100 * (1 - percent / 100) / USED) ** 0.5))

    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                        lambda i: F.xxhash64(i, F.substring("sig", i * 4 * BAND_ROWS + 1, F.lit(4 * BAND_ROWS))))
    banded = classes.select("cls", "n", F.explode(bands).alias("band"))
    first = banded.groupBy("band").agg(F.count("*").alias("many"), F.min(F.struct("cls", "n")).alias("p")).where("many > 1")
    met = saved(banded.join(first.select("band", F.col("p.cls").alias("pivot"), F.col("p.n").alias("n_pivot")), "band").where("cls <> pivot"), "buckets")

    # One text of each class that shares a bucket; only rows that a bitmap of their keys lets through are shuffled.
    named = saved(met.select("cls").unionByName(met.select(F.col("pivot").alias("cls"))).distinct(), "named")
    some = sifted(classes.select("cls", "row", "n", "sig", F.xxhash64("cls").alias("key")), "key", bitmap(named.select(F.xxhash64("cls").alias("key"))))
    pooled = saved(some.drop("key").join(named, "cls"), "pooled")
    side = pooled.select("cls", "n", "sig")
    texts_of = documents.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    pool = saved(sifted(texts_of, "row", bitmap(pooled.select("row"))).join(pooled.select("row", "cls"), "row").dropDuplicates(["cls"]), "pool")

    def texts_for(wanted: DataFrame) -> DataFrame:
        """cls, text for some classes."""
        rows = saved(wanted.join(pooled.select("row", "cls"), "cls").select("row", "cls"), "wanted")
        return sifted(pool.select("row", "text"), "row", bitmap(rows.select("row"))).join(rows, "row").select("cls", "text")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b), those that reach the threshold."""
        a, b = (side.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab")
        sized = pairs.distinct().join(a, "a").join(b, "b").select("a", "b", "sig_a", "sig_b", _most(F.col("n_a") + F.col("n_b"), percent).alias("most"))
        near = saved(_plausible(sized, least), "plausible")
        wanted = near.select(F.col("a").alias("cls")).unionByName(near.select(F.col("b").alias("cls"))).distinct()
        return saved(_verified(near, texts_for(wanted), k, percent), "links")

    fits = 100 * F.least("n", "n_pivot") >= percent * F.greatest("n", "n_pivot")
    links = linked(met.where(fits).select(F.col("pivot").alias("a"), F.col("cls").alias("b")))
    roots = saved(components(links), "roots")
    # A pivot has met all classes of its buckets. What is in one component needs no further pairs.
    grouped = met.select("pivot", "cls", "n", "n_pivot").distinct().join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    grouped = saved(grouped, "grouped")
    several = grouped.groupBy("pivot").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("pivot")
    members = saved(grouped.join(several, "pivot"), "members")
    wanted = members.select("cls").unionByName(members.select(F.col("pivot").alias("cls"))).distinct()
    found = saved(_prefix_pairs(members, side, texts_for(wanted), k, percent), "found")
    # Of all pairs between two components the likeliest first; then those between components that are still apart.
    likeliest = saved(found.groupBy("low", "high").agg(F.max(F.struct("slack", "a", "b")).alias("pair")).select("pair.a", "pair.b"), "likeliest")
    links = links.unionByName(linked(likeliest))
    roots = saved(components(links), "roots")
    a, b = (roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    apart = found.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
    links = links.unionByName(linked(apart.select("a", "b").join(likeliest, ["a", "b"], "left_anti")))
    roots = saved(components(links), "roots")

    rooted = classes.join(roots, classes["cls"] == roots["node"], "left").select("cls", "lead", F.coalesce("root", "cls").alias("root"))
    first = rooted.groupBy("root").agg(F.min("lead").alias("lead"))
    names = rooted.select("cls", "root").join(first, "root").select("cls", F.col("lead.doc_id").alias("component_id"), F.col("lead.row").alias("lead"))
    return signed.select("doc_id", "row", "n", "cls").join(names, "cls", "left").select(
        "doc_id", "row", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("lead")).otherwise(F.col("row")).alias("lead"))


def deduplicate(documents: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns; of rows that are equal in doc_id and text, one. Texts without words all stay."""
    key = next(f"row{'_' * i}" for i in range(1, 99) if f"row{'_' * i}" not in documents.columns)
    leads = near_duplicates(documents, k, percent).where(F.col("row") == F.col("lead")).select(
        F.col("row").alias(key), (F.col("n_shingles") > 0).alias("worded")).distinct()
    keyed = documents.withColumn(key, row_key(F.col("doc_id"), F.col("text")))
    kept = keyed.join(leads, key)
    return kept.where("worded").dropDuplicates([key]).unionByName(kept.where("not worded")).select(*documents.columns)
