"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is ``window`` consecutive words of an item (all words of a shorter item).
Its tokens are shingles of up to ``SHINGLE`` words. Since a document must hold
every shingle of a window, one necessary prefix token is enough to find it: the
shingle that is rarest over all documents. Documents send only those of their
shingles that a bitmap of fixed size lets through, with their position and the
words around it; a plain join on the shingle, the length bound (the document has
as many words), the positional bound (the window fits before and after) and a
comparison of the very words leave the exact occurrences.

The bitmap has a fixed size whatever the benchmark's; a larger benchmark lets more
rows through to the join and changes no result.

Defined cases: null or wordless texts have no words and no windows; a null
item_id is the item with the empty id; rows of one item_id count as one item;
repeated document rows each get the full answer; a null doc_id is kept; empty
tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostermart.llm.bitmaps import bitmap, passes
from rostermart.llm.texts import (LETTERS, U64, Words, find_words, hash_runs, hash_words, lowered, row_key, run_starts,
                                  slices)
from rostermart.sources.scratch import saved

SHINGLE = 3


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, words (a window's, joined by blanks), length, shingles: each distinct window of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = find_words(part, LETTERS)
                hashes = hash_words(part, found)
                runs = {k: hash_runs(hashes, k) for k in range(1, SHINGLE + 1)}
                rows: list[tuple] = []
                for i, n in enumerate(found.counts):
                    lo = int(found.first[i])
                    words = lowered(part, found, lo, lo + n)
                    length = min(window, int(n))
                    k = min(SHINGLE, length)
                    item = batch.column("item_id")[part.lo + i].as_py() or ""
                    for s in range(n - length + 1 if length else 0):
                        tokens = runs[k][lo + s:lo + s + length - k + 1].view(np.int64).tolist()
                        rows.append((item, " ".join(words[s:s + length]), length, tokens))
                item, words, length, tokens = zip(*rows, strict=True) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.string()), pa.array(words, pa.string()), pa.array(length, pa.int32()),
                     pa.array(tokens, pa.list_(pa.int64()))], names=["item_id", "words", "length", "shingles"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return items.mapInArrow(cut, "item_id string, words string, length int, shingles array<long>").dropDuplicates(["item_id", "words"])


def _hits(found: Words, hashes: np.ndarray, sizes: list[int], bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word places and hashes of the shingles that pass."""
    for k in sizes:
        starts = run_starts(found, k)
        if len(starts):
            mine = hash_runs(hashes, k)[starts]
            passed = passes(bits, mine)
            yield starts[passed], mine[passed]


def _frequencies(documents: DataFrame, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """shingle, n: how often the documents hold each shingle that passes the bitmap."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                found = find_words(part, LETTERS)
                got = [h for _, h in _hits(found, hash_words(part, found), sizes, bits)]
                each, n = np.unique(np.concatenate(got or [np.zeros(0, U64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(each.view(np.int64)), pa.array(n)], names=["shingle", "n"])

    return documents.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def _candidates(documents: DataFrame, sizes: list[int], bits: np.ndarray, window: int) -> DataFrame:
    """doc_id, row, n_words, found: for each document row its shingles that pass, with the words around them."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = find_words(part, LETTERS)
                rows: list[list] = [[] for _ in range(part.hi - part.lo)]
                text_of = found.texts()
                for places, mine in _hits(found, hash_words(part, found), sizes, bits):
                    for at, h in zip(places.tolist(), mine.view(np.int64).tolist(), strict=True):
                        i = int(text_of[at])
                        lo, hi = max(int(found.first[i]), at - window + 1), min(int(found.first[i + 1]), at + window)
                        rows[i].append({"shingle": h, "at": at - int(found.first[i]), "before": at - lo, "around": lowered(part, found, lo, hi)})
                head = batch.slice(part.lo, part.hi - part.lo)
                yield pa.RecordBatch.from_arrays(
                    [head.column("doc_id"), head.column("row"), pa.array(found.counts, pa.int64()), pa.array(rows, kind)],
                    names=["doc_id", "row", "n_words", "found"])

    kind = pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("around", pa.list_(pa.string()))]))
    docs = documents.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")
    doc_id = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(find, f"doc_id {doc_id}, row long, n_words long, "
                                 "found array<struct<shingle:long,at:int,before:int,around:array<string>>>")


def find_contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, row, n_words, n_hit, n_items, items (their ids, sorted) of each document row.

    ``row`` is the key of the row's contents (``texts.row_key`` of doc_id and text).
    """
    windows = saved(_windows(benchmark, window), "windows")
    distinct = windows.dropDuplicates(["words"]).select("words", "length", "shingles")
    tokens = distinct.select("words", "length", F.posexplode("shingles").alias("offset", "shingle"))
    sizes = sorted(r.k for r in distinct.select(F.least(F.lit(SHINGLE), "length").alias("k")).distinct().collect())
    counted = _frequencies(documents, sizes, bitmap(tokens.select("shingle")))
    prefix = saved(tokens.join(counted, "shingle", "left").groupBy("words", "length")
                   .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("rarest"))
                   .select("words", "length", "rarest.shingle", "rarest.offset"), "prefix")
    docs = saved(_candidates(documents, sizes, bitmap(prefix.select("shingle")), window), "candidates")

    candidates = docs.select("row", "n_words", F.explode("found").alias("c")).select("row", "n_words", "c.*")
    start = F.col("at") - F.col("offset")
    inside = (F.col("n_words") >= F.col("length")) & (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    there = F.array_join(F.slice("around", F.greatest(F.col("before") - F.col("offset") + 1, F.lit(1)), F.col("length")), " ")
    matches = saved(candidates.join(prefix, "shingle").where(inside & (there == F.col("words")))
                    .select("row", "words", start.alias("start"), (start + F.col("length")).alias("end")).distinct(), "matches")

    by_start = Window.partitionBy("row").orderBy("start")
    spans = matches.groupBy("row", "start").agg(F.max("end").alias("end")).withColumn(
        "done", F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    new = F.greatest(F.col("end") - F.greatest("start", F.coalesce("done", F.lit(0))), F.lit(0))
    hit = spans.groupBy("row").agg(F.sum(new).cast("long").alias("n_hit"))
    items = (matches.select("row", "words").distinct().join(windows.select("item_id", "words"), "words")
             .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    none = F.array().cast("array<string>")
    return (docs.select("doc_id", "row", "n_words").join(hit, "row", "left").join(items, "row", "left")
            .select("doc_id", "row", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", none).alias("items")))


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, with all their columns, that hold no window of the benchmark."""
    key = next(f"row{'_' * i}" for i in range(1, 99) if f"row{'_' * i}" not in documents.columns)
    hit = find_contamination(documents, benchmark, window).where("n_hit > 0").select(F.col("row").alias(key)).distinct()
    keyed = documents.withColumn(key, row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(hit, key, "left_anti").select(*documents.columns)
