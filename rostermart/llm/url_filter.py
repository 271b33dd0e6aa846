"""URL filters: rules first, else a logistic regression on hashed character n-grams.

The labelled table is the part of the urls that a rule decides, up to
``max_labelled`` of them for each verdict, taken in the order of a hash; no
other knowledge goes into the weights. Host n-grams and path n-grams are hashed
into separate halves of one weight vector; the host is framed by ``.`` and
``/`` so that n-grams know its ends.

Defined cases: a null url or one without ``://`` has an empty host and path and
is decided by the model's intercept alone; with labels of one verdict only, that
verdict; with none, allow. Repeated rows each get the same answer; null page ids
stay; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostermart.llm.texts import LOWER, U64, mix, slices

SLOTS = 1 << 15
SIZES = (3, 4, 5)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.translate(
        F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path_of(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct of name and verdict; null if none does."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _features(hosts: pa.Array, paths: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For runs of rows: the row and the slot of every n-gram, and the number of rows."""
    framed = [pa.array([f".{h}/" for h in hosts.to_pylist()], pa.string()), pa.array(paths.to_pylist(), pa.string())]
    rows, slots = [], []
    for half, column in enumerate(framed):
        for part in slices(column):
            low = LOWER[part.data].astype(U64)
            place = np.arange(len(low))
            row = np.searchsorted(part.offsets, place, "right") - 1
            ends = part.offsets[1:][row]
            total = np.zeros(len(low), U64)
            for k in range(min(max(SIZES), len(low))):
                total[:len(low) - k] = total[:len(low) - k] * U64(257) + low[k:] + U64(1)
                if k + 1 in SIZES:
                    whole = place + k < ends
                    rows.append(row[whole] + part.lo)
                    slots.append((mix(total[whole] + U64(k)) % U64(SLOTS)).astype(np.int64) + half * SLOTS)
    yield np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(slots or [np.zeros(0, np.int64)]), len(hosts)


@dataclass
class UrlModel:
    weights: np.ndarray
    intercept: float

    def scores(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        """The probability of ``block``; the weights of a row's n-grams are averaged by the root of their number."""
        out = np.zeros(len(hosts))
        for rows, slots, n in _features(hosts, paths):
            many = np.maximum(np.bincount(rows, minlength=n), 1)
            out = np.bincount(rows, self.weights[slots], minlength=n) / np.sqrt(many) + self.intercept
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(hosts: list[str], paths: list[str], block: np.ndarray, steps: int = 150, l2: float = 1e-3) -> UrlModel:
    """Full-batch gradient descent with momentum; both classes weigh the same."""
    n = len(block)
    model = UrlModel(np.zeros(2 * SLOTS), 0.0)
    if not n or block.all() or not block.any():
        model.intercept = 10.0 if n and block.all() else -10.0
        return model
    weight = np.where(block, 0.5 / block.sum(), 0.5 / (~block).sum())
    (rows, slots, _), = _features(pa.array(hosts), pa.array(paths))
    scale = 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
    speed, speed0 = np.zeros_like(model.weights), 0.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(np.bincount(rows, model.weights[slots], minlength=n) * scale + model.intercept)))
        error = (p - block) * weight
        speed = 0.9 * speed + np.bincount(slots, (error * scale)[rows], minlength=2 * SLOTS) + l2 * model.weights
        speed0 = 0.9 * speed0 + error.sum()
        model.weights -= 2.0 * speed
        model.intercept -= 2.0 * speed0
    return model


def judge(pages: DataFrame, rules: Sequence[Rule], max_labelled: int = 2000) -> DataFrame:
    """page_id, host, path, rule, verdict, score (of the model: block likelier the higher)."""
    url = F.col("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).na.fill("", ["host", "path"])
    parts = parts.withColumn("fits", rule_for(F.col("host"), F.col("path"), rules))
    labelled = parts.where("fits is not null").select("host", "path", F.col("fits.verdict").alias("verdict")).distinct()
    hosts, paths, block = [], [], []
    for verdict in ("allow", "block"):
        rows = (labelled.where(F.col("verdict") == verdict)
                .orderBy(F.xxhash64("host", "path"), "host", "path").limit(max_labelled).collect())
        hosts += [r.host for r in rows]
        paths += [r.path for r in rows]
        block += [verdict == "block"] * len(rows)
    model = train(hosts, paths, np.array(block, bool))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.scores(batch.column("host"), batch.column("path")))],
                names=[*batch.schema.names, "score"])

    flat = parts.select("page_id", "host", "path", F.col("fits.name").alias("rule"), F.col("fits.verdict").alias("ruled"))
    kinds = dict(flat.dtypes)
    scored = flat.mapInArrow(score, ", ".join(f"{c} {kinds[c]}" for c in flat.columns) + ", score double")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
