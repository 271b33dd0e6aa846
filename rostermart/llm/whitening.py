"""Embedding whitening: leading principal components by Jacobi-Davidson, with products that Spark computes.

The covariance is never formed. A product with a block of vectors is one Spark
pass over the distinct vectors: every task multiplies its centred rows with the
block and back, and the partial sums are added in the order of the tasks. The
driver holds only vectors of the embedding's own dimension. An outer step solves
the projected correction equations of all pairs that are not yet locked by a few
steps of MINRES, whose columns share each pass; widens the basis; and takes
Ritz pairs from it. Pairs are locked when their residual reaches the rounding
of double precision.

Entries are read as integers, ``floor(64 * c) + 1000000`` by default. Distinct
vectors count once in every statistic.

Defined cases: vectors that are null, empty, or hold null or non-finite entries
take no part, nor do vectors of another length than the most frequent one (of
equally frequent lengths, the longer); an entry of 2**47 or more is an error, as
is a deviation beyond a long; repeated rows and rows without an id are whitened
each; components whose variance is zero to double precision are left out, so one
distinct vector, or none, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermart.llm.tidy import tidy
from rostermart.sources.scratch import saved

EPS = np.finfo(float).eps
#: Largest entry of a vector that is read.
LIMIT = 2.0 ** 47
#: So many partial sums at most go to the driver; those of more tasks are added by Spark first.
PARTIALS = 256


def integer_vectors(embeddings: DataFrame, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """vec_id and ``x``, the vector as longs, of each row that takes part, whatever its length."""
    known = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    entry = lambda c: F.when(F.abs(c) < LIMIT, F.floor(scale * c.cast("double")).cast("long") + shift).otherwise(
        F.raise_error(F.lit("an entry of an embedding is too large")).cast("long"))
    kept = embeddings.select("vec_id", "embedding").where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(known)
    return kept.select("vec_id", F.transform("embedding", entry).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


@dataclass
class Centre:
    """Number and sums of the distinct vectors; centring subtracts whole parts as integers first."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums), strict=True)
        self.whole, self.rest = np.array(whole, np.int64), np.array(rest, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """The sum over dimensions of (n * x - sum)**2, exact."""
        near = x - self.whole
        largest = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if x.shape[1] * largest ** 2 < 1 << 63:
            return ((near * self.n - self.rest) ** 2).sum(1)
        exact = ((near.astype(object) * self.n - self.rest.astype(object)) ** 2).sum(1)
        if max(exact, default=0) >= 1 << 63:
            raise OverflowError("a deviation does not fit a long")
        return exact.astype(np.int64)


def _summed(vectors: DataFrame, tasks: int, of_rows: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of ``of_rows`` over all rows of ``x``, read in so many tasks; added in their order, so that reruns agree."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += of_rows(_matrix(batch.column("x")))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["task", "total"])

    def add(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("task")
        total = sum((np.frombuffer(b.as_py()) for b in parts["total"]), np.zeros(int(np.prod(shape))))
        return pa.table({"task": parts["task"][:1], "total": pa.array([total.tobytes()], pa.binary())})

    kind = "task int, total binary"
    parts = vectors.select("x").mapInArrow(tidy(partial), kind)
    if tasks > PARTIALS:
        parts = parts.groupBy(F.col("task") % PARTIALS).applyInArrow(add, kind)
    rows = sorted(parts.collect(), key=lambda r: r.task)
    return sum((np.frombuffer(r.total).reshape(shape) for r in rows), np.zeros(shape))


def _lanczos_solve(multiply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """MINRES from zero for ``multiply(z) = right``, each column a system of its own; the columns share every product."""
    size = np.linalg.norm(right, axis=0)
    out = np.zeros_like(right)
    now, before = right / np.maximum(size, 1e-300), np.zeros_like(right)
    beta, left = np.zeros_like(size), size.copy()
    cos1, sin1, cos2, sin2 = np.ones_like(size), np.zeros_like(size), np.ones_like(size), np.zeros_like(size)
    way, way_before = np.zeros_like(right), np.zeros_like(right)
    for _ in range(steps):
        after = multiply(now) - beta * before
        alpha = (now * after).sum(0)
        after -= alpha * now
        next_beta = np.linalg.norm(after, axis=0)
        # The column of the tridiagonal matrix under the two last rotations, then the new one.
        far, mid = sin2 * beta, cos2 * beta
        near, top = cos1 * mid + sin1 * alpha, cos1 * alpha - sin1 * mid
        length = np.hypot(top, next_beta)
        going = length > 1e-14 * (np.abs(alpha) + next_beta + 1e-300)
        length = np.where(going, length, 1)
        cos, sin = np.where(going, top / length, 1), np.where(going, next_beta / length, 0)
        step = np.where(going, (now - near * way - far * way_before) / length, 0)
        out += np.where(going, cos * left, 0) * step
        left = np.where(going, -sin * left, 0)
        way_before, way = way, step
        before, now = now, after / np.where(next_beta > 0, next_beta, 1)
        beta, cos2, sin2, cos1, sin1 = next_beta, cos1, sin1, cos, sin
    return out


def _new_directions(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal ``basis``."""
    block = block / np.maximum(np.linalg.norm(block, axis=0), 1e-300)
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    made, size, _ = np.linalg.svd(block, full_matrices=False)
    made = made[:, size > 1e-8][:, :basis.shape[0] - basis.shape[1]]
    made = made - basis @ (basis.T @ made)
    return np.linalg.qr(made)[0] if made.shape[1] else made


def jacobi_davidson(multiply: Callable[[np.ndarray], np.ndarray], d: int, k: int, inner: int = 6, widest: int | None = None,
                    outer: int = 300, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric non-negative operator, falling, their unit vectors as columns, and the residuals' norms."""
    k, widest = min(k, d), min(d, widest or max(4 * k, k + 32))
    rng = np.random.default_rng(seed)
    basis = np.linalg.qr(rng.standard_normal((d, k)))[0]
    image = multiply(basis)
    for _ in range(outer):
        inside = basis.T @ image
        found, turn = np.linalg.eigh((inside + inside.T) / 2)
        turn = turn[:, ::-1]
        values = found[::-1][:k]
        ritz, ritz_image = basis @ turn[:, :k], image @ turn[:, :k]
        residual = ritz_image - ritz * values
        size = np.linalg.norm(residual, axis=0)
        open_ = size > 64 * EPS * np.sqrt(d) * max(values[0], 0)
        if not open_.any() or basis.shape[1] == d:
            # One fresh product with the pairs themselves: nothing is carried over from earlier steps.
            ritz = np.linalg.qr(ritz)[0]
            ritz_image = multiply(ritz)
            inside = ritz.T @ ritz_image
            found, turn = np.linalg.eigh((inside + inside.T) / 2)
            values, turn = found[::-1], turn[:, ::-1]
            ritz, ritz_image = ritz @ turn, ritz_image @ turn
            return values, ritz, np.linalg.norm(ritz_image - ritz * values, axis=0)
        if basis.shape[1] + open_.sum() > widest and widest < d:
            keep = min(basis.shape[1], k + k // 2)
            basis, image = basis @ turn[:, :keep], image @ turn[:, :keep]
        project = lambda z: z - ritz @ (ritz.T @ z)  # noqa: B023, E731
        shift = values[open_]
        correction = _lanczos_solve(lambda z: project(multiply(project(z)) - shift * project(z)), -project(residual[:, open_]), inner)  # noqa: B023
        added = _new_directions(correction, basis)
        if not added.shape[1]:  # nothing new came out of the corrections
            added = _new_directions(rng.standard_normal((d, 1)), basis)
        basis, image = np.hstack([basis, added]), np.hstack([image, multiply(added)])
    raise RuntimeError(f"{int(open_.sum())} of {k} components did not reach double precision in {outer} steps")


@dataclass
class Whitening:
    """What whitening needs: the centre, the components as columns, their variances, all variance, and how white the fit list becomes."""

    centre: Centre
    components: np.ndarray
    variances: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.variances)


def fit(embeddings: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000) -> Whitening | None:
    """The whitening of the distinct vectors; None where nothing varies."""
    vectors = integer_vectors(embeddings, scale, shift)
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return None
    d = lengths.d
    distinct = saved(vectors.where(F.size("x") == d).select("x").distinct(), "whitening-fit")
    n, tasks = distinct.count(), distinct.rdd.getNumPartitions()
    sums = {r.pos: r.s for r in distinct.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).collect()}
    centre = Centre(n, [int(sums[i]) for i in range(d)])

    def multiply(block: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            centred = centre.centred(x)
            return centred.T @ (centred @ block)

        return _summed(distinct, tasks, product, block.shape) / n

    trace = float(_summed(distinct, tasks, lambda x: (centre.centred(x) ** 2).sum(keepdims=True).reshape(1), (1,))[0]) / n
    if trace == 0:
        return None
    variances, vectors_, residuals = jacobi_davidson(multiply, d, components)
    real = variances > 1e-12 * variances[0]
    variances, vectors_ = variances[real], vectors_[:, real]
    vectors_ = vectors_ * np.sign(vectors_[np.abs(vectors_).argmax(0), np.arange(vectors_.shape[1])])
    made = Whitening(centre, vectors_, variances, trace, residuals[real], 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        white = np.hstack([made.whitened(x), np.ones((len(x), 1))])
        return white.T @ white

    total = _summed(distinct, tasks, moments, (len(variances) + 1,) * 2) / n
    mean = total[-1, :-1]
    made.identity_error = float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(len(variances))).max())
    return made


def apply(embeddings: DataFrame, model: Whitening, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """vec_id, deviation (long) and whitened (an array with one double per component) of each row that takes part."""
    d = len(model.components)
    vectors = integer_vectors(embeddings, scale, shift).where(F.size("x") == d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x")) if batch.num_rows else np.zeros((0, d), np.int64)
            white = model.whitened(x)
            ends = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(model.centre.deviation(x), pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(white.reshape(-1)))],
                names=["vec_id", "deviation", "whitened"])

    return vectors.mapInArrow(tidy(run), f"vec_id {dict(vectors.dtypes)['vec_id']}, deviation long, whitened array<double>")


def whitened(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    model = fit(embeddings, components)
    if model is None:
        kind = dict(embeddings.dtypes)["vec_id"]
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.variances])
    rows = apply(embeddings, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.centre.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error")).select(*columns)
