"""Exact top-k by inner product: ball trees per shard, branch and bound.

Candidates are dealt over shards; each shard builds one ball tree and, for a
block of queries, visits its leaves by falling upper bound ``q . centre + |q| *
radius`` until no bound reaches the k-th score held so far. One seed shard goes
first; what it finds is the starting k-th score of every query in all other
shards, so that their trees begin with a bound instead of learning one each.

Vectors are integer (each component is ``floor(scale * x)``), so scores are
exact and ties are broken by the smaller id.

Defined cases: vectors that are null or hold a null, infinite or NaN component
take no part, neither as query nor as candidate; nor do null ids. Vectors of
another length than a query's never meet it; empty ones meet each other with
score 0. Every row is a candidate and a query of its own, whatever id others
have: rows that repeat an id are asked one by one, and only the row itself is not its
candidate. Components of 2**52 or more after scaling are an error, and so is a
pair of vectors whose score might not fit a long. Fewer than k candidates give fewer rows; an empty
table gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostermart.sources.scratch import saved

LEAF = 256
EXACT = 2 ** 53  # whole numbers below it are exact as doubles
LIMIT = 2.0 ** 52


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    lo: int
    hi: int
    reach: float
    children: tuple[Node, Node] | None = None


class BallTree:
    """Splits at the median along the direction between two far points; rows of a node lie side by side."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.arange(len(vectors))
        self.vectors = vectors
        self.leaf = leaf
        self.root = self._node(0, len(vectors)) if len(vectors) else None
        self.vectors = vectors[self.order]
        self.most = float(np.abs(vectors).max()) if vectors.size else 0.0
        self.floats = self.vectors.astype(np.float64)

    def _node(self, lo: int, hi: int) -> Node:
        rows = self.vectors[self.order[lo:hi]].astype(np.float64)
        centre = rows.mean(0)
        away = np.sqrt(((rows - centre) ** 2).sum(1))
        node = Node(centre, float(away.max()), lo, hi, float(np.abs(centre).max(initial=0)))
        if hi - lo > self.leaf and node.radius > 0:
            far = rows[int(away.argmax())]
            other = rows[int(((rows - far) ** 2).sum(1).argmax())]
            along = np.argsort(rows @ (other - far), kind="stable")
            self.order[lo:hi] = self.order[lo:hi][along]
            middle = (lo + hi) // 2
            node.children = self._node(lo, middle), self._node(middle, hi)
        return node


class _Best:
    """The k best of one query: by score, then the smaller id."""

    def __init__(self, k: int, floor: int | None) -> None:
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def kth(self) -> float:
        held = float(self.scores[-1]) if len(self.scores) == self.k else -np.inf
        return held if self.floor is None else max(held, float(self.floor))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
            first = np.lexsort((ids, -scores))[:self.k]
            self.scores, self.ids = scores[first], ids[first]


def search(tree: BallTree, ids: np.ndarray, rows: np.ndarray, query: np.ndarray, own: int, best: _Best) -> None:
    """Nodes go from the highest bound down; the search ends at the first bound below the k-th score. ``own`` is the query's row."""
    import heapq

    length, q = float(np.sqrt((query.astype(np.float64) ** 2).sum())), query.astype(np.float64)

    def bound(node: Node) -> float:
        b = float(q @ node.centre) + length * node.radius
        return b + 1e-9 * (abs(b) + length * (node.radius + node.reach) + 1)

    largest = tree.most * float(np.abs(query).sum())
    if largest >= 2.0 ** 63:
        raise OverflowError("a score may not fit a long")
    floats = tree.floats if largest < EXACT else None
    heap = [(-bound(tree.root), 0, tree.root)] if tree.root else []
    made = 1
    while heap:
        minus, _, node = heapq.heappop(heap)
        if -minus < best.kth():
            return
        if node.children:
            for child in node.children:
                b = bound(child)
                if b >= best.kth():
                    heapq.heappush(heap, (-b, made, child))
                    made += 1
        else:
            if floats is not None:  # no partial sum can leave the exact range
                scores = (floats[node.lo:node.hi] @ q).astype(np.int64)
            else:
                scores = tree.vectors[node.lo:node.hi] @ query
            near = np.flatnonzero(scores >= best.kth())
            if len(near):
                near = near[rows[node.lo + near] != own]
                best.add(scores[near], ids[node.lo + near])


def integer_vectors(table: DataFrame, scale: int) -> DataFrame:
    """vec_id and v: whole, finite vectors as integers; ``floor(scale * x)`` with x as double."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    return (table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & x.isNotNull() & finite)
            .select("vec_id", F.transform(x, lambda e: F.when(F.abs(e.cast("double") * scale) < LIMIT, F.floor(e.cast("double") * scale).cast("long"))
                                          .otherwise(F.raise_error(F.lit("a component of an embedding is too large")).cast("long"))).alias("v")))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), width)


def _searched(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each shard for each query; both sides carry shard, part and width."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        width = key[2].as_py()
        if left.num_rows and right.num_rows:
            ids = np.asarray(left["vec_id"])
            tree = BallTree(_matrix(left["v"], width))
            ids, rows_of = ids[tree.order], np.asarray(left["row"])[tree.order]
            vectors = _matrix(right["q"], width)
            floors = right["floor"].to_pylist()
            for i, (asked, own) in enumerate(zip(right["query_id"].to_pylist(), right["key"].to_pylist(), strict=True)):
                best = _Best(k, floors[i])
                search(tree, ids, rows_of, vectors[i], own, best)
                out[0] += [asked] * len(best.ids)
                out[1] += [own] * len(best.ids)
                out[2] += best.ids.tolist()
                out[3] += best.scores.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["query_id", "key", "vec_id", "score"])

    by = ("shard", "part", "width")
    return rows.groupBy(*by).cogroup(queries.groupBy(*by)).applyInArrow(run, "query_id long, key long, vec_id long, score long")


def top_k(table: DataFrame, is_query: Column, k: int = 5, scale: int = 256, shard_rows: int = 16384, block: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on ``vec_id``.

    ``shard_rows`` bounds a shard, ``block`` the queries that meet a shard in one
    task; both are sizes of pieces, and every block meets every shard.
    """
    vectors = saved(integer_vectors(table, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = vectors.count()
    asked = vectors.where(is_query)
    n_shards, n_parts = max(1, -(-n // shard_rows)), max(1, -(-asked.count() // block))
    shard = F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int")
    rows = vectors.select("vec_id", "v", "row", F.size("v").alias("width"), shard.alias("shard"))
    queries = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.size("v").alias("width"), F.col("row").alias("key"),
                           F.pmod(F.xxhash64("row", "vec_id"), F.lit(n_parts)).cast("int").alias("part"))

    def against(shards: Column, some: DataFrame) -> DataFrame:
        return some.select("query_id", "key", "q", "width", "part", "floor", F.explode(shards).alias("shard"))

    def all_parts(some: DataFrame) -> DataFrame:
        return some.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))

    first = queries.withColumn("floor", F.lit(None).cast("long"))
    found = saved(_searched(all_parts(rows.where("shard = 0")), against(F.array(F.lit(0)), first), k), "top-seed")
    if n_shards > 1:
        floors = found.groupBy("key").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        rest = queries.join(floors, "key", "left")
        others = F.sequence(F.lit(1), F.lit(n_shards - 1))
        found = found.unionByName(_searched(all_parts(rows.where("shard > 0")), against(others, rest), k))
    order = Window.partitionBy("query_id", "key").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
