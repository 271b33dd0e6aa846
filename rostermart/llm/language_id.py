"""Language identification: the mean of hashed subword vectors through a linear softmax.

Subwords are byte strings of 2, 3 and 4 bytes of words in lower case (A-Z), with a
mark at either end of a word; no subword spans two words. Each is hashed to one
of BUCKETS learned vectors; a text is the mean over all its subwords.

Vectors and softmax are trained by stochastic gradient descent on a bounded
sample: ``per_lang`` rows of each language and ``rows`` in all, rarer languages
first. Tasks turn whole sampled texts into counts of buckets; three steps of four
see only a few subwords of each text, so that short texts are learned too. A
fifth of the sample is kept from training: on it a temperature is fitted that
makes the scores probabilities, and the score below which an answer is rejected,
so that ``rejected_share`` of its right answers would be.

Defined cases: null texts and texts without a letter are ``und`` with score 0; with no
usable row to learn from, all are; with one language, all other texts are that one; a
subword never seen adds nothing, so a text of such subwords gets the least
sure answer and is rejected; rows with equal texts get equal answers. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostermart.llm.texts import BYTE_VALUES, LETTERS, U64, Slice, held_out_expr, mix, slices
from rostermart.llm.tidy import tidy
from rostermart.sources.scratch import saved

BUCKETS, VECTOR = 1 << 15, 16
SIZES = (2, 3, 4)
LETTER = r"\p{L}"
UNKNOWN = "und"
_TURN = U64(0x9E3779B97F4A7C15)


def subwords(part: Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each subword length, the bucket of every subword and the text it is in (as its place in the slice), in order."""
    n = part.hi - part.lo
    sizes = np.diff(part.offsets)
    text = np.repeat(np.arange(n), sizes)
    # Every text begins with a mark of its own; bytes outside words are marks as well.
    inside = np.zeros(len(part.data) + n + 1, bool)
    value = np.full(len(inside), U64(1))
    place = np.arange(len(part.data)) + text + 1
    inside[place] = LETTERS[part.data]
    value[place] = np.where(LETTERS[part.data], BYTE_VALUES[part.data], U64(1))
    owner = np.append(np.repeat(np.arange(n), sizes + 1), n)
    for size in SIZES:
        many = len(inside) - size + 1
        if many <= 0:
            continue
        good = inside[:many] | inside[size - 1:size - 1 + many]
        code = value[:many].copy()
        for j in range(1, size):
            code *= _TURN
            code += value[j:j + many]
            if j < size - 1:
                good &= inside[j:j + many]
        if size > 2:  # with only marks around it a shorter subword says the same
            good &= inside[1:1 + many]
        at = np.flatnonzero(good)
        yield (mix(code[at] + U64(size)) & U64(BUCKETS - 1)).astype(np.int32), owner[at]


@dataclass
class Model:
    """Vectors of the buckets, the softmax over ``langs``, its temperature and the score of a rejected answer."""

    langs: list[str]
    vectors: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0
    least: float = 0.0

    def logits(self, means: np.ndarray) -> np.ndarray:
        return means @ self.weights + self.bias

    def scores(self, means: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(means) / self.temperature)

    def means(self, part: Slice) -> np.ndarray:
        n = part.hi - part.lo
        total, many = np.zeros((n, VECTOR)), np.zeros(n)
        for buckets, owner in subwords(part):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            if len(first):
                total[owner[first]] += np.add.reduceat(self.vectors[buckets], first)
                many += np.bincount(owner, minlength=n)
        return total / np.maximum(many, 1)[:, None]

    def predict(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The language, the score and whether the answer is rejected for each text."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        said = pc.fill_null(pc.match_substring_regex(texts, LETTER), False).to_numpy(zero_copy_only=False)
        if not self.langs or not len(texts):
            return pa.array([UNKNOWN] * len(texts), pa.string()), np.zeros(len(texts)), np.ones(len(texts), bool)
        p = self.scores(np.concatenate([self.means(part) for part in slices(texts)]))
        best = p.argmax(1)
        score = np.where(said, p[np.arange(len(p)), best], 0.0)
        lang = pa.DictionaryArray.from_arrays(pa.array(np.where(said, best, len(self.langs)).astype(np.int32)), pa.array([*self.langs, UNKNOWN]))
        return lang.cast(pa.string()), score, ~said | (score < self.least)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Bags:
    """Counts of buckets of some texts, end to end."""

    buckets: np.ndarray
    counts: np.ndarray
    first: np.ndarray

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, weights (each text's sum to 1) and where each of the texts begins."""
        many = self.first[rows + 1] - self.first[rows]
        begin = np.cumsum(many) - many
        at = np.repeat(self.first[rows] - begin, many) + np.arange(many.sum())
        counts = self.counts[at].astype(np.float64)
        return self.buckets[at], counts / np.repeat(np.add.reduceat(counts, begin), many), begin

    def few(self, rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``of``, over 1 to 64 subwords drawn from each text."""
        buckets, weights, begin = self.of(rows)
        running, many = np.cumsum(weights), (2 ** rng.uniform(0, 6, len(rows))).astype(np.int64)
        text = np.repeat(np.arange(len(rows)), many)
        drawn = buckets[np.minimum(np.searchsorted(running, text + rng.random(len(text)), "right"), len(buckets) - 1)]
        return drawn, (1 / many)[text], np.cumsum(many) - many


def train(bags: Bags, y: np.ndarray, langs: list[str], steps: int = 1600, batch: int = 32, rate: float = 24.0, seed: int = 11) -> Model:
    """Plain SGD on the log loss with a falling rate; languages weigh the same whatever their share of the sample."""
    rng = np.random.default_rng(seed)
    model = Model(langs, np.zeros((BUCKETS, VECTOR)), rng.standard_normal((VECTOR, len(langs))) / np.sqrt(VECTOR), np.zeros(len(langs)))
    share = np.bincount(y, minlength=len(langs)) * len(langs) / max(1, len(y))
    order = np.zeros(0, np.int64)
    for step in range(steps if len(langs) > 1 else 0):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(y))])
        rows, order = order[:batch], order[batch:]
        buckets, weights, begin = bags.few(rows, rng) if step % 4 else bags.of(rows)
        means = np.add.reduceat(model.vectors[buckets] * weights[:, None], begin)
        error = _softmax(model.logits(means))
        error[np.arange(len(rows)), y[rows]] -= 1
        error *= (1 / np.maximum(share, 1e-9))[y[rows]][:, None] / len(rows)
        now = rate * (1 - step / steps)
        back = np.repeat(error @ model.weights.T, np.diff(begin, append=len(buckets)), axis=0) * weights[:, None]
        for v in range(VECTOR):
            model.vectors[:, v] -= now * np.bincount(buckets, back[:, v], minlength=BUCKETS)
        model.weights -= 0.02 * now * (means.T @ error)
        model.bias -= 0.002 * now * error.sum(0)
    return model


def calibrate(model: Model, bags: Bags, y: np.ndarray, rejected_share: float) -> None:
    """Temperature and least score from rows that training has not seen, half of them cut down to few subwords."""
    if not len(y) or len(model.langs) < 2:
        return
    rows, rng = np.arange(len(y)), np.random.default_rng(3)
    means = [np.add.reduceat(model.vectors[b] * w[:, None], f) for b, w, f in (bags.of(rows), bags.few(rows, rng))]
    logits, truth = model.logits(np.concatenate(means)), np.concatenate([y, y])
    right = np.arange(len(truth)), truth
    model.temperature = float(min(np.geomspace(0.05, 20, 121), key=lambda t: -np.log(_softmax(logits / t)[right] + 1e-12).mean()))
    p = _softmax(logits / model.temperature)
    good = p.argmax(1) == truth
    model.least = float(np.quantile(p[right][good], rejected_share)) if good.any() else 0.0


def training_bags(documents: DataFrame, per_lang: int, rows: int, mod: int = 5) -> DataFrame:
    """doc_id, lang, buckets, counts of the sampled documents, from their whole texts."""
    known = documents.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & ~held_out_expr(F.col("doc_id"), mod) & F.coalesce(F.col("text").rlike(LETTER), F.lit(False)))
    ids = saved(known.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct(), "language-ids")
    # Before rows of a language are ranked, only those with a hash in its first part stay, which holds twice as many as are wanted.
    # The sizes are a written table: a few languages are joined without dealing the rows by language before the cut.
    many = saved(ids.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    part = F.col("h") / F.lit(2.0 ** 64) + 0.5
    first = ids.join(many, "lang").where(part * F.col("n") < 2 * per_lang + 64)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = first.withColumn("nth", nth).where(F.col("nth") <= per_lang).orderBy("nth", "lang").limit(rows).select("doc_id", "lang")
    texts = (known.join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang")
             .agg(F.min_by("text", F.xxhash64("text")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in slices(batch.column("text"), 1):  # a text at a time
                b, c = np.unique(np.concatenate([np.zeros(0, np.int32), *(x for x, _ in subwords(part))]), return_counts=True)
                found.append((b, c))
            ends = np.cumsum([0, *(len(b) for b, _ in found)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int32))) for x in zip(*found, strict=True)]
            if found:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), batch.column("lang"), *lists], names=["doc_id", "lang", "buckets", "counts"])

    return texts.mapInArrow(tidy(run), "doc_id string, lang string, buckets array<int>, counts array<int>")


def fit(documents: DataFrame, per_lang: int = 500, rows: int = 8000, rejected_share: float = 0.01) -> Model:
    """The model of a bounded sample, made in one task from its counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = [b for b in batches if b.num_rows]
        if not some:
            return
        table = pa.Table.from_batches(some).sort_by([("doc_id", "ascending"), ("lang", "ascending")]).combine_chunks()
        langs = sorted(pc.unique(table["lang"]).to_pylist(), key=str.encode)
        y = pc.index_in(table["lang"], pa.array(langs)).to_numpy().astype(np.int64)
        lists = table["buckets"].combine_chunks()
        many = lists.value_lengths().to_numpy()
        bags = Bags(lists.flatten().to_numpy(), table["counts"].combine_chunks().flatten().to_numpy(), np.append(0, np.cumsum(many)))
        apart = np.arange(len(y)) % 5 == 4
        whole = np.flatnonzero(~apart)
        model = train(_rows(bags, whole), y[whole], langs)
        calibrate(model, _rows(bags, np.flatnonzero(apart)), y[apart], rejected_share)
        model.vectors = model.vectors.astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["made"])

    made = training_bags(documents, per_lang, rows).coalesce(1).mapInArrow(tidy(run), "made binary").first()
    return pickle.loads(made.made) if made else Model([], np.zeros((BUCKETS, VECTOR)), np.zeros((VECTOR, 0)), np.zeros(0))


def _rows(bags: Bags, rows: np.ndarray) -> Bags:
    many = bags.first[rows + 1] - bags.first[rows]
    at = np.repeat(bags.first[rows] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    return Bags(bags.buckets[at], bags.counts[at], np.append(0, np.cumsum(many)))


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rejected = model.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lang, pa.array(score), pa.array(rejected)],
                                             names=["doc_id", "lang_pred", "score", "rejected"])

    narrow = documents.select("doc_id", "text")
    return narrow.mapInArrow(tidy(run), f"doc_id {dict(narrow.dtypes)['doc_id']}, lang_pred string, score double, rejected boolean")


def judged(documents: DataFrame, per_lang: int = 500, rows: int = 8000) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of each document, by a model of those that are not held out."""
    found = identify(documents, fit(documents, per_lang, rows))
    return found.select("doc_id", held_out_expr(F.col("doc_id"), 5).alias("held_out"), "lang_pred", "score", "rejected")
