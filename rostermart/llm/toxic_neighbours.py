"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and their first 4, 5 and 6 bytes (so that inflected words share a
term). All terms of the examples are weighed and indexed. Weights are
``(1 + ln tf) * idf * (1 + ln(1 + chi))``, of length one: inverse document
frequencies are counted over all documents, and ``chi`` is the chi-square of the
term's presence and the label in the sample, so that a term of both labels alike
counts least, but counts.

Examples lie in blocks of BLOCK, sorted by their heaviest term. Rare terms have
postings; terms in more than a share COMMON of the examples have a row of weights
in each block and their largest weight there. A text's bound for a block is its
largest sum over the rare terms in the block and its weights times these largest
ones; the FIRST blocks of highest bound are opened, then all whose bound reaches
the K-th similarity found, so the K nearest are exact (ties to the earlier example).
Where the rare terms' sums leave most blocks open, all are opened at once.

Neighbours vote by ``1 / (1 - similarity + SOFT)``, weighted so that the sample's
label shares become those of all labels, next to a vote for the overall share. A
logistic curve fitted on each example's own leave-one-out vote calibrates it.

Defined cases: texts without a term of any example, null and empty ones among
them, have no neighbour and get the score of the overall share; with labels of
one class only, all scores are that label, with none 0.5; repeated rows get equal
scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.llm.labelled import fitted, fitted_bytes, training_sample, unpacked
from rostermart.llm.texts import (BYTE_VALUES, LETTERS, U64, _powers, find_words, held_out_expr, mix, slices)
from rostermart.llm.tidy import small_batches, tidy

PREFIXES = (4, 5, 6)
BLOCK, K, SOFT, PRIOR = 64, 15, 0.1, 1.0
COMMON, FIRST, AT_ONCE = 0.1, 8, 128
#: Counts sent in one batch, and postings that are weighed at once.
SENT, WEIGHED = 1 << 16, 1 << 17
#: Postings of a text that are added up at once.
PIECE = 24_000


def terms_of(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of rows: first row, number of rows, and the row and hash of every term occurrence."""
    for part in slices(column):
        found = find_words(part, LETTERS)
        n = part.hi - part.lo
        if not len(found.starts):
            yield part.lo, n, np.zeros(0, np.int64), np.zeros(0, U64)
            continue
        up, down = _powers(len(part.data))
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_VALUES[part.data] * up)])
        text, size = found.texts(), found.ends - found.starts
        rows, hashes = [text], [mix((sums[found.ends] - sums[found.starts]) * down[found.starts])]
        for k in PREFIXES:
            longer = np.flatnonzero(size > k)
            s = found.starts[longer]
            rows.append(text[longer])
            hashes.append(mix((sums[s + k] - sums[s]) * down[s] + U64(k)))
        yield part.lo, n, np.concatenate(rows), np.concatenate(hashes)


def choose_terms(sample: pd.DataFrame) -> np.ndarray:
    """Sorted hashes of all terms of the sample."""
    y = sample["y"].to_numpy()
    if not len(y) or y.min() == y.max():
        return np.zeros(0, np.int64)
    each = [np.unique(hashes) for _, _, _, hashes in terms_of(pa.array(sample["text"], pa.string()))]
    return np.sort(np.unique(np.concatenate(each)).view(np.int64))


def count_documents(documents: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, over all of them, and the number of documents."""
    if not len(terms):
        return np.zeros(0), 0
    small_batches(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(np.sort(terms.view(U64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = sent.value, 0
        doors, total = _doors(known), np.zeros(len(known), np.int64)
        for batch in batches:
            n += batch.num_rows
            for _, _, rows, hashes in terms_of(batch.column(0)):
                r, t = _known(rows, hashes, known, doors)
                total += np.bincount(_distinct(r * len(known) + t) % len(known), minlength=len(known))
        found = np.flatnonzero(total)
        for lo in range(0, len(found) + 1, SENT):
            part = found[lo:lo + SENT]
            yield pa.RecordBatch.from_arrays([pa.array(np.append(known[part].view(np.int64), 0)), pa.array(np.append(total[part], 0)),
                                              pa.array(np.append(np.zeros(len(part), np.int64), 0 if lo else n))], names=["term", "df", "n"])

    counted = documents.select("text").mapInArrow(tidy(run), "term long, df long, n long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).toArrow()
    term, df = counted.column("term").to_numpy(), counted.column("df").to_numpy()
    sort = np.argsort(terms)
    at = np.minimum(np.searchsorted(terms[sort], term), len(terms) - 1)
    same = terms[sort][at] == term
    out = np.zeros(len(terms))
    out[sort[at[same]]] = df[same]
    return out, int(counted.column("n").to_numpy().sum())


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The sorted keys, each once: sorting them costs a tenth of numpy's own way, a table of hashes."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])[:len(keys)]]


def _doors(sorted_terms: np.ndarray) -> tuple[np.ndarray, np.uint64]:
    """Where the terms of each run of upper bits begin, about one term to a run, and the shift that gives a hash's run."""
    bits = max(1, int(len(sorted_terms)).bit_length())
    shift = U64(64 - bits)
    return np.searchsorted(sorted_terms, np.arange(1 << bits, dtype=U64) << shift).astype(np.int32), shift


def _known(rows: np.ndarray, hashes: np.ndarray, sorted_terms: np.ndarray, doors: tuple[np.ndarray, np.uint64] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The occurrences of known terms, as rows and places in ``sorted_terms``."""
    first, shift = doors or _doors(sorted_terms)
    last = len(sorted_terms) - 1
    at = np.minimum(first[(hashes >> shift).view(np.int64)], last)
    found = sorted_terms[at]
    behind = np.flatnonzero(found < hashes)
    while len(behind):  # hashes are spread, so a run has few terms
        behind = behind[at[behind] < last]
        at[behind] += 1
        found[behind] = sorted_terms[at[behind]]
        behind = behind[found[behind] < hashes[behind]]
    same = found == hashes
    return rows[same], at[same].astype(np.int64)


@dataclass
class Index:
    terms: np.ndarray
    factor: np.ndarray
    share: float
    y: np.ndarray
    names: list
    vote: np.ndarray
    common: np.ndarray
    blocks: np.ndarray
    largest: np.ndarray
    pointer: np.ndarray
    ids: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0
    tf: np.ndarray | None = None
    length: np.ndarray | None = None
    doors: tuple[np.ndarray, np.uint64] | None = None
    rare: np.ndarray | None = None
    begin: np.ndarray | None = None

    def __getstate__(self) -> dict:
        """Postings as example and count; the weights and the rows of common terms are made from them again."""
        held = {k: v for k, v in self.__dict__.items() if k not in ("blocks", "largest", "weights", "rare", "begin", "ids", "tf", "pointer", "doors")}
        return held | {"ids": _small(self.ids), "tf": _small(self.tf), "many": _small(np.diff(self.pointer))}

    def __setstate__(self, held: dict) -> None:
        """Opens the index to search it; what only packing needs is let go."""
        many, held = held["many"], {k: v for k, v in held.items() if k != "many"}
        self.__dict__.update(held, pointer=np.append(0, np.cumsum(many, dtype=np.int64)))
        self._weigh()
        self.ids = self.tf = self.pointer = None

    def _weigh(self) -> None:
        """Examples and weights of the rare terms' postings, and the rows of the common terms with their largest weights in each block."""
        many = np.where(self.common < 0, np.diff(self.pointer), 0)
        self.begin = np.append(0, np.cumsum(many))
        self.rare, self.weights = np.empty(self.begin[-1], np.int32), np.empty(self.begin[-1])
        many_blocks = -(-len(self.y) // BLOCK)
        self.blocks = np.zeros((int((self.common >= 0).sum()), many_blocks * BLOCK))
        logs = 1 + np.log(np.arange(1, int(self.tf.max(initial=1)) + 1))
        to = 0
        for lo in range(0, len(self.ids), WEIGHED):  # a worker opens the index beside others: no copies as long as all postings
            own = slice(lo, min(lo + WEIGHED, len(self.ids)))
            first, last = np.searchsorted(self.pointer, [own.start, own.stop - 1], "right") - 1
            t = np.repeat(np.arange(first, last + 1), np.diff(self.pointer[first:last + 2].clip(own.start, own.stop)))
            ids = self.ids[own].astype(np.int32)
            w = logs[self.tf[own].astype(np.int64) - 1] * self.factor[t] / self.length[ids]
            often = self.common[t] >= 0
            self.blocks[self.common[t[often]], ids[often]] = w[often]
            upto = to + len(t) - int(often.sum())
            self.rare[to:upto], self.weights[to:upto] = ids[~often], w[~often]
            to = upto
        self.doors = _doors(self.terms)
        self.largest = self.blocks.reshape(len(self.blocks), many_blocks, BLOCK).max(2)

    def vectors(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of rows: first row, number of rows, and row, term and weight of each part of their vectors."""
        for lo, n, rows, hashes in terms_of(column):
            if not len(self.terms):
                yield lo, n, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
                continue
            r, t = _known(rows, hashes, self.terms, self.doors)
            key, tf = np.unique(r * len(self.terms) + t, return_counts=True)
            r, t = key // len(self.terms), key % len(self.terms)
            w = (1 + np.log(tf)) * self.factor[t]
            length = np.sqrt(np.bincount(r, w * w, minlength=n))
            yield lo, n, r, t, w / length[r]

    def nearest(self, t: np.ndarray, w: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The K examples of highest similarity above 0 and these similarities."""
        return next(self.nearest_of(1, np.zeros(len(t), np.int64), t, w, np.array([skip])))

    def nearest_of(self, n: int, r: np.ndarray, t: np.ndarray, w: np.ndarray, skip: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each of ``n`` vectors, whose parts are sorted by vector."""
        edges = np.linspace(0, n, -(-n // AT_ONCE) + 1).astype(np.int64)  # groups of one size: a small last one costs nearly as much
        for lo, hi in zip(edges, edges[1:], strict=False):
            own = slice(*np.searchsorted(r, [lo, hi]))
            for mine, floor in zip(*self._similarities(hi - lo, r[own] - lo, t[own], w[own], np.full(hi - lo, -1) if skip is None else skip[lo:hi]), strict=True):
                some = np.flatnonzero(mine >= floor - 1e-11)
                near = mine[some].round(12)
                best = np.flatnonzero(near >= max(_kth(near), 1e-12))
                best = best[np.lexsort((some[best], -near[best]))[:K]]
                yield near[best], some[best]

    def _similarities(self, n: int, r: np.ndarray, t: np.ndarray, w: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Similarities to all examples, exact in each block that may hold one of the K nearest, and for each vector a number that K of them reach."""
        many_blocks = self.largest.shape[1]
        sims, dense = np.zeros((n, many_blocks * BLOCK)), np.zeros((n, len(self.largest)))
        often = self.common[t] >= 0
        dense[r[often], self.common[t[often]]] = w[often]
        r, t, w = r[~often], t[~often], w[~often]
        lo, many = self.begin[t], self.begin[t + 1] - self.begin[t]
        edges, ends, counting = np.searchsorted(r, np.arange(n + 1)), np.cumsum(many), np.arange(PIECE + len(self.y))
        for i in np.flatnonzero(np.diff(edges)):
            own = slice(edges[i], edges[i + 1])
            for piece in self._pieces(own.start, own.stop, ends):
                last = np.cumsum(many[piece])
                at = np.repeat(lo[piece] - last + many[piece], many[piece])
                at += counting[:len(at)]
                weights = np.repeat(w[piece], many[piece])
                weights *= self.weights.take(at, mode="clip")  # no place is outside; looking for one takes as long as the rest
                sims[i] += np.bincount(self.rare.take(at, mode="clip"), weights, minlength=sims.shape[1])
        skipped = np.flatnonzero(skip >= 0)
        bound = sims.reshape(n, many_blocks, BLOCK).max(2) + dense @ self.largest
        sims[skipped, skip[skipped]] = -1
        floor = np.array([_kth(mine) for mine in sims])
        if 2 * np.count_nonzero(bound >= floor[:, None]) > bound.size:  # rare terms alone rule few blocks out: one product of all costs less than the blocks one by one
            sims += dense @ self.blocks
            sims[skipped, skip[skipped]] = -1
            return sims, floor
        best = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
        wanted = np.zeros(bound.shape, bool)
        np.put_along_axis(wanted, best, True, 1)
        closed = ~wanted
        for last in (False, True):
            for block in np.flatnonzero(wanted.any(0)):
                q = np.flatnonzero(wanted[:, block])
                own = slice(block * BLOCK, (block + 1) * BLOCK)
                sims[q, own] += dense[q] @ self.blocks[:, own]
            sims[skipped, skip[skipped]] = -1
            if not last:
                floor = np.array([_kth(mine) for mine in sims])
                wanted = closed & (bound > 0) & (bound >= floor[:, None] - 1e-11)
        return sims, floor

    @staticmethod
    def _pieces(lo: int, hi: int, ends: np.ndarray) -> Iterator[slice]:
        """Runs of the terms ``lo`` to ``hi`` of about PIECE postings, of which ``ends`` has the running number, so that they stay in the cache."""
        while lo < hi:
            start = int(ends[lo - 1]) if lo else 0
            upto = min(hi, max(lo + 1, int(np.searchsorted(ends, start + PIECE, "right"))))
            yield slice(lo, upto)
            lo = upto

    def raw(self, sims: np.ndarray, ids: np.ndarray) -> float:
        """The log odds of the votes."""
        v = self.vote[ids] / (1 - np.minimum(sims, 1) + SOFT) * sims
        one = float(v[self.y[ids] == 1].sum()) + PRIOR * self.share
        return float(np.log(one / (v.sum() + PRIOR - one)))

    def score(self, raw: np.ndarray | float) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(raw) + self.offset, -30, 30)))


def _kth(sims: np.ndarray) -> float:
    """The K-th largest."""
    return float(np.partition(sims, -K)[-K])


@dataclass
class Parts:
    """The vectors of the examples, not weighed yet: those of row i have terms ``t`` and counts ``tf`` from ``edges[i]`` to ``edges[i + 1]``."""

    t: np.ndarray
    tf: np.ndarray
    edges: np.ndarray

    @classmethod
    def of(cls, column: pa.Array, sorted_terms: np.ndarray) -> Parts:
        doors, terms, counts, many = _doors(sorted_terms), [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)], np.zeros(len(column) + 1, np.int64)
        for lo, n, rows, hashes in terms_of(column):
            r, t = _known(rows, hashes, sorted_terms, doors)
            key, tf = np.unique(r * len(sorted_terms) + t, return_counts=True)
            terms.append((key % len(sorted_terms)).astype(np.int32))
            counts.append(_small(tf))
            many[lo + 1:lo + n + 1] = np.bincount(key // len(sorted_terms), minlength=n)
        return cls(np.concatenate(terms), np.concatenate(counts), np.cumsum(many))

    def rows(self, which: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in ``which``, term and weight, before it is divided by the length, of each part of these rows."""
        many = self.edges[which + 1] - self.edges[which]
        at = np.repeat(self.edges[which] - np.cumsum(many) + many, many) + np.arange(many.sum())
        t = self.t[at].astype(np.int64)
        return np.repeat(np.arange(len(which)), many), t, (1 + np.log(self.tf[at].astype(np.int64))) * factor[t]


def _small(x: np.ndarray) -> np.ndarray:
    """In the smallest type that holds the numbers, which are not negative."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def label_dependence(y: np.ndarray, parts: Parts, many: int) -> np.ndarray:
    """The chi-square of each of ``many`` terms' presence and the label."""
    in_any, in_one = np.bincount(parts.t, minlength=many).astype(float), np.zeros(many)
    for i in np.flatnonzero(y):
        in_one[parts.t[parts.edges[i]:parts.edges[i + 1]]] += 1
    n, ones = float(len(y)), float(y.sum())
    return n * (n * in_one - ones * in_any) ** 2 / np.maximum(ones * (n - ones) * in_any * (n - in_any), 1e-9)


def build(sample: pd.DataFrame, terms: np.ndarray, df: np.ndarray, n: int, share: float) -> Index:
    """The index of the sample's examples, calibrated."""
    sort = np.argsort(terms.view(U64))
    idf = np.log((1 + n) / (1 + df[sort])) + 1 if len(terms) else np.zeros(0)
    y = sample["y"].to_numpy(np.int64)
    index = Index(terms.view(U64)[sort], idf, share, y, [], np.zeros(0), np.full(len(terms), -1), np.zeros((0, 0, BLOCK)), np.zeros((0, 0)),
                  np.zeros(len(terms) + 1, np.int64), np.zeros(0, np.int32), np.zeros(0), tf=np.zeros(0, np.int64), length=np.zeros(0))
    if not len(y) or y.min() == y.max():
        index.slope, index.offset = 0.0, 0.0 if not len(y) else 30.0 if y[0] else -30.0
        return index
    parts = Parts.of(pa.array(sample["text"], pa.string()), index.terms)
    if len(terms):
        index.factor = idf * (1 + np.log1p(label_dependence(y, parts, len(terms))))
    length, heaviest = np.zeros(len(y)), np.full(len(y), len(terms))
    for own in _runs(len(y)):
        r, t, w = parts.rows(own, index.factor)
        length[own] = np.sqrt(np.bincount(r, w * w, minlength=len(own)))
        w = w / length[own][r]
        most = np.zeros(len(own))
        np.maximum.at(most, r, w)
        largest = w == most[r]
        heaviest[own[r[largest]]] = t[largest]  # the last of equal ones
    order = np.lexsort((np.arange(len(y)), y, heaviest))
    index.y, index.names, index.length = y[order], sample["doc_id"].to_numpy()[order].tolist(), length[order]
    index.vote = np.where(index.y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    many = np.bincount(parts.t, minlength=len(terms))
    often = np.flatnonzero(many > len(y) * COMMON)
    index.common[often] = np.arange(len(often))
    index.pointer = np.append(0, np.cumsum(many))
    index.ids, index.tf, free = np.empty(len(parts.t), np.int32), np.empty(len(parts.t), parts.tf.dtype), index.pointer[:-1].copy()
    for e, i in enumerate(order):  # a term's examples in their order; an example has a term once
        own = slice(parts.edges[i], parts.edges[i + 1])
        at = free[parts.t[own]]
        index.ids[at], index.tf[at] = e, parts.tf[own]
        free[parts.t[own]] += 1
    index._weigh()
    raw = np.zeros(len(y))
    for own in _runs(len(y)):
        r, t, w = parts.rows(order[own], index.factor)
        raw[own] = [index.raw(*near) for near in index.nearest_of(len(own), r, t, w / index.length[own][r], own)]
    index.slope, index.offset = _calibrated(raw, index.y, index.vote)
    return index


def _runs(n: int) -> Iterator[np.ndarray]:
    """The numbers below ``n`` in runs of AT_ONCE."""
    for lo in range(0, n, AT_ONCE):
        yield np.arange(lo, min(n, lo + AT_ONCE))


def _calibrated(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps with a little pull towards slope 1; the slope stays positive."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        g = np.array([((p - y) * weight * raw).sum() + (a - 1), ((p - y) * weight).sum() + b])
        s = p * (1 - p) * weight
        h = np.array([[(s * raw * raw).sum() + 1, (s * raw).sum()], [(s * raw).sum(), s.sum() + 1]])
        step = np.linalg.solve(h, g)
        a, b = max(0.1, a - step[0]), b - step[1]
    return float(a), float(b)


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = 3000) -> bytes:
    """The packed index: terms and examples from a bounded sample, document frequencies from all documents. The driver does not open it."""
    sample, share = training_sample(documents, labels, label, per_class)
    terms = fitted(sample, choose_terms)
    df, n = count_documents(documents, terms)
    return fitted_bytes(sample, lambda rows: build(rows, terms, df, n, share))


def judge(documents: DataFrame, index: bytes) -> DataFrame:
    """All columns of the documents as ``row``, with score and evidence (doc_id, similarity and label of the nearest examples)."""
    sent = documents.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = unpacked(sent.value)  # for this task alone: an executor has more workers than tasks at a time, and those that wait must not hold it
        names = pa.array(index.names, pa.string())
        alone = index.raw(np.zeros(0), np.zeros(0, np.int64)) if index.slope else 0.0
        for batch in batches:
            rows = batch.column("row")
            for lo, n, r, t, w in index.vectors(rows.field("text")):  # sent run by run: what goes back is held in pieces only
                raw, many = np.full(n, alone), np.zeros(n + 1, np.int32)
                near, their = [np.zeros(0)], [np.zeros(0, np.int64)]
                for i, (sims, ids) in enumerate(index.nearest_of(n, r, t, w)) if index.slope else ():
                    raw[i] = index.raw(sims, ids)
                    many[i + 1] = len(ids)
                    near.append(sims)
                    their.append(ids)
                ids = np.concatenate(their)
                each = pa.StructArray.from_arrays([names.take(pa.array(ids)), pa.array(np.concatenate(near)), pa.array(index.y[ids].astype(np.int32))],
                                                  names=["doc_id", "similarity", "label"])
                evidence = pa.ListArray.from_arrays(pa.array(np.cumsum(many, dtype=np.int32)), each)
                yield pa.RecordBatch.from_arrays([rows.slice(lo, n), pa.array(index.score(raw)), evidence], names=["row", "score", "evidence"])

    small_batches(documents.sparkSession)
    packed = documents.select(F.struct(*documents.columns).alias("row"))
    return packed.mapInArrow(tidy(run), f"row {dict(packed.dtypes)['row']}, score double, evidence array<struct<doc_id:string,similarity:double,label:int>>")


def judged(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = 3000) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of each document."""
    narrow = documents.select("doc_id", "text")
    scored = judge(narrow, fit(documents, labels, per_class=per_class))
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id.alias("doc_id"), held_out_expr(doc_id, 5).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "evidence")


def keep_clean(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = 3000) -> DataFrame:
    """The documents, with all their columns, whose score is below the threshold."""
    return judge(documents, fit(documents, labels, per_class=per_class)).where(F.col("score") < threshold).select("row.*")
