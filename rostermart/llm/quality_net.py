"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into chunks of CHUNK bytes that overlap by CHUNK - STEP and
cover all of it. Each byte has a learned vector; learned filters of WIDTH bytes
slide over a chunk byte by byte, and the largest answer of each filter stands for the chunk.
The chunks' answers, averaged and at their largest, go through one hidden layer
into one probability.

Training takes a bounded sample of labelled rows (``per_class`` of each label);
training and scoring take every chunk of every text.

Defined cases: null and empty texts are one chunk of padding and get a score like
any other; with labels of one class only, all scores are that label, with none
0.5; repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.llm.labelled import fitted, training_sample
from rostermart.llm.texts import held_out_expr, slices
from rostermart.llm.tidy import tidy

CHUNK, STEP = 512, 448
WIDTH = 8
VECTOR, FILTERS, HIDDEN = 6, 32, 16
PAD = 256
AT_ONCE, KEPT = 128, 512


def chunk_bounds(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text and the first byte of each chunk; every text has at least one."""
    many = np.maximum(1, -(-(sizes - (CHUNK - STEP)) // STEP))
    text = np.repeat(np.arange(len(sizes)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    return text, nth * STEP


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of each chunk; PAD beyond its text's end."""
    place = starts[:, None] + np.arange(CHUNK)
    out = np.full(place.shape, PAD, np.int64)
    inside = place < ends[:, None]
    out[inside] = data[place[inside]]
    return out


@dataclass
class Net:
    vectors: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, seed: int) -> Net:
        rng = np.random.default_rng(seed)
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        vectors = normal(PAD + 1, VECTOR, scale=0.5)
        vectors[PAD] = 0
        return cls(vectors, normal(WIDTH * VECTOR, FILTERS, scale=(WIDTH * VECTOR) ** -0.5), np.zeros(FILTERS, np.float32),
                   normal(2 * FILTERS, HIDDEN, scale=(2 * FILTERS) ** -0.5), np.zeros(HIDDEN, np.float32),
                   normal(HIDDEN, scale=HIDDEN ** -0.5), np.zeros(1, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.vectors, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The largest answer of each filter in each chunk, where it is, and the windows that were seen."""
        seen = self.vectors[chunks].reshape(len(chunks), -1)
        windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * VECTOR, axis=1)[:, ::VECTOR]
        windows = np.ascontiguousarray(windows)
        answers = (windows.reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(len(chunks), -1, FILTERS)
        where = answers.argmax(1)
        best = np.take_along_axis(answers, where[:, None], 1)[:, 0] + self.bias
        return np.maximum(best, 0), where, windows

    def largest(self, chunks: np.ndarray) -> np.ndarray:
        seen = self.vectors[chunks].reshape(len(chunks), -1)
        windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(seen, WIDTH * VECTOR, axis=1)[:, ::VECTOR])
        answers = (windows.reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(len(chunks), -1, FILTERS)
        return np.maximum(answers.max(1) + self.bias, 0)

    def head(self, chunk_answers: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """The probability of each of ``n`` texts; ``text`` names each chunk's text, in order."""
        first = np.searchsorted(text, np.arange(n))
        both = np.concatenate([np.add.reduceat(chunk_answers, first) / np.diff(np.append(first, len(text)))[:, None],
                               np.maximum.reduceat(chunk_answers, first)], 1)
        logit = np.tanh(both @ self.hidden + self.hidden_bias) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))

    def scores(self, column: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for part in slices(column, 1 << 18):
            text, starts = chunk_bounds(np.diff(part.offsets))
            starts, ends = starts + part.offsets[text], part.offsets[text + 1]
            answers = [self.largest(cut(part.data, starts[i:i + AT_ONCE], ends[i:i + AT_ONCE])) for i in range(0, len(text), AT_ONCE)]
            out.append(self.head(np.concatenate(answers), text, part.hi - part.lo))
        return np.concatenate(out).astype(np.float64)


@dataclass
class Cuts:
    """The chunks of some texts in order, cut when they are asked for."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Cuts:
        ends = np.cumsum([len(t) for t in texts])
        sizes = np.diff(ends, prepend=0)
        text, starts = chunk_bounds(sizes)
        return cls(np.frombuffer(b"".join(texts), np.uint8), starts + (ends - sizes)[text], ends[text], text)

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, at: slice) -> np.ndarray:
        return cut(self.data, self.starts[at], self.ends[at])


def _gradients(net: Net, chunks: np.ndarray | Cuts, text: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n = len(y)
    parts, found = [], []
    for i in range(0, len(chunks), AT_ONCE):
        part = net.pooled(chunks[i:i + AT_ONCE])
        found.append(part[0])
        parts.append(part if i < KEPT else None)  # windows of more chunks are made again below
    answers = np.concatenate(found)
    first = np.searchsorted(text, np.arange(n))
    many = np.diff(np.append(first, len(text)))[:, None]
    top = np.maximum.reduceat(answers, first)
    both = np.concatenate([np.add.reduceat(answers, first) / many, top], 1)
    hidden = np.tanh(both @ net.hidden + net.hidden_bias)
    p = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.out_bias, -30, 30)))
    d_logit = ((p - y) * weight).astype(np.float32)
    d_hidden = d_logit[:, None] * net.out * (1 - hidden ** 2)
    d_both = d_hidden @ net.hidden.T
    is_top = answers == top[text]
    shared = np.add.reduceat(is_top.astype(np.float32), first)
    d_answer = (d_both[:, :FILTERS] / many)[text] + (d_both[:, FILTERS:] / shared)[text] * is_top
    d_answer *= answers > 0
    d_filters, d_vectors = np.zeros_like(net.filters), np.zeros_like(net.vectors)
    for k, part in enumerate(parts):
        at = slice(k * AT_ONCE, (k + 1) * AT_ONCE)
        mine = chunks[at]
        _, where, windows = part or net.pooled(mine)
        d = d_answer[at]
        seen = windows[np.arange(len(where))[:, None], where]
        d_filters += np.einsum("cf,cfk->kf", d, seen)
        d_seen = d[:, :, None] * net.filters.T[None]
        bytes_at = mine[np.arange(len(where))[:, None, None], where[:, :, None] + np.arange(WIDTH)]
        flat = bytes_at.reshape(-1)
        d_seen = d_seen.reshape(-1, VECTOR)
        for v in range(VECTOR):
            d_vectors[:, v] += np.bincount(flat, d_seen[:, v], minlength=PAD + 1).astype(np.float32)
    d_vectors[PAD] = 0
    return [d_vectors, d_filters, d_answer.sum(0), both.T @ d_hidden, d_hidden.sum(0), hidden.T @ d_logit, np.array([d_logit.sum()], np.float32)]


def train(sample: pd.DataFrame, seed: int = 7, steps: int = 700, batch: int = 48, rate: float = 4e-3) -> Net:
    """Adam on the log loss, the same number of steps for any sample; both labels weigh the same; batches in a fixed pseudorandom order."""
    net, y = Net.new(seed), sample["y"].to_numpy(np.float32)
    if not len(y) or y.min() == y.max():
        net.out[:] = 0
        net.out_bias[:] = 0 if not len(y) else 20 if y[0] else -20
        return net
    raw = [t.encode("utf-8", "replace") for t in sample["text"]]
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    rng = np.random.default_rng(seed)
    m, v = [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()]
    step = 0
    while step < steps:
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch)[:steps - step]:
            rows = order[lo:lo + batch]
            chunks = Cuts.of([raw[i] for i in rows])
            step += 1
            now = rate * (1 - step / (steps + 1))
            for w, g, m1, v1 in zip(net.weights(), _gradients(net, chunks, chunks.text, y[rows], weight[rows] / len(rows)), m, v, strict=True):
                m1 += 0.1 * (g - m1)
                v1 += 0.01 * (g * g - v1)
                w -= now * (m1 / (1 - 0.9 ** step)) / (np.sqrt(v1 / (1 - 0.99 ** step)) + 1e-8)
    return net


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = 1200) -> Net:
    """A network trained on a sample of as many rows of either label, its probabilities moved to the share of label 1 among all labels."""
    sample, share = training_sample(documents, labels, label, per_class)
    net = fitted(sample, train)
    if 0 < share < 1:
        net.out_bias = net.out_bias + np.float32(np.log(share / (1 - share)))
    return net


def score(documents: DataFrame, net: Net) -> DataFrame:
    """``row`` (a struct of all the documents' columns) and ``score`` for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            yield pa.RecordBatch.from_arrays([rows, pa.array(net.scores(rows.field("text")))], names=["row", "score"])

    packed = documents.select(F.struct(*documents.columns).alias("row"))
    return packed.mapInArrow(tidy(run), f"row {dict(packed.dtypes)['row']}, score double")


def judged(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = 1200) -> DataFrame:
    """doc_id, held_out, score, predicted of each document."""
    net = fit(documents, labels, per_class=per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.scores(batch.column("text")))], names=["doc_id", "score"])

    narrow = documents.select("doc_id", "text")
    scored = narrow.mapInArrow(tidy(run), f"doc_id {dict(narrow.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out_expr(F.col("doc_id"), 5).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = 1200) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""
    return score(documents, fit(documents, labels, per_class=per_class)).where(F.col("score") >= threshold).select("row.*")
