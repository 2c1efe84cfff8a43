"""Nearest neighbours by a blocked matrix join: int8 product tiles with error bounds, exact distances for what survives.

A vector x is stored as int8 codes q and a scale s with residual e = x - s q. For two vectors, s s' (q . q') is off x . y by at
most |x^| |e'| + |e| |y^| + |e| |e'|, which bounds the squared distance from both sides. In a tile of a block of queries
and a block of candidates, a pair survives unless its lower bound exceeds the k-th smallest upper bound that its query
has seen so far. Survivors are recomputed in double precision on the original vectors and kept in a heap per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators.scale import settle

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 2048
# products of this many int8 pairs still add up exactly in a 32-bit float
_EXACT = 1024


def usable(vector: Column) -> Column:
    """Not null or zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale, norm of the decoded vector and norm of the residual, per row."""
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    code = np.rint(x / scale[:, None]).clip(-127, 127).astype(np.int8)
    back = code * scale[:, None]
    slack = 1 + 1e-9
    return code, scale, np.linalg.norm(back, axis=1) * slack, np.linalg.norm(x - back, axis=1) * slack


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows, in slices short enough for exact 32-bit float sums."""
    total = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], _EXACT):
        total += a[:, i : i + _EXACT].astype(np.float32) @ b[:, i : i + _EXACT].astype(np.float32).T
    return total


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise Euclidean distances in double precision, adding up components in their order."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        difference = a[:, i] - b[:, i]
        total += difference * difference
    return np.sqrt(total)


class Tile:
    """A block of queries with its heaps of the k nearest found so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, vectors, k
        self.code, self.scale, self.norm, self.rest = quantised(vectors)
        self.square = (vectors * vectors).sum(axis=1)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.limit = np.full(len(ids), np.inf)  # the k-th smallest squared distance, or a bound above it

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        code, scale, norm, rest = quantised(vectors)
        dot = products(self.code, code) * self.scale[:, None] * scale[None, :]
        error = self.norm[:, None] * rest[None, :] + self.rest[:, None] * (norm + rest)[None, :]
        middle = self.square[:, None] + (vectors * vectors).sum(axis=1)[None, :] - 2 * dot
        slack = 1e-9 * (np.abs(middle) + 1)
        low, high = middle - 2 * error - slack, middle + 2 * error + slack
        own = self.ids[:, None] == ids[None, :]
        high[own], low[own] = np.inf, np.inf
        if len(ids) >= self.k:
            self.limit = np.minimum(self.limit, np.partition(high, self.k - 1, axis=1)[:, self.k - 1])
        q, c = np.nonzero((low <= self.limit[:, None]) & ~own)
        for at, candidate, distance in zip(q.tolist(), ids[c].tolist(), distances(self.x[q], vectors[c]).tolist()):
            heap, entry = self.heaps[at], (-distance, -candidate)
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        for at in np.unique(q).tolist():
            if len(self.heaps[at]) == self.k:
                worst = self.heaps[at][0][0]
                self.limit[at] = min(self.limit[at], worst * worst * (1 + 1e-12))

    def rows(self) -> pd.DataFrame:
        found = [(q, -c, -d) for q, heap in zip(self.ids.tolist(), self.heaps) for d, c in heap]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def _blocks(vectors: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """Vectors of one length dealt by a hash to blocks of about ``rows`` rows: (dim, block, ids, flat)."""
    total = vectors.count()
    count = 1 + total // rows
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int"))
    packed = dealt.groupBy("dim", "block").agg(F.collect_list(F.struct("vec_id", "vector")).alias("rows"))
    return settle(packed, name), count


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` nearest other vectors of each query: query_id, rank (from 1), vec_id, score (Euclidean distance).

    Nearest first, ties to the smaller vec_id; all candidates if there are fewer than k. Vectors that are null, zero or
    hold null or non-finite components, and rows without an id, take no part. Vectors of another length than the
    query's are no candidates. Rows that repeat a vec_id count once, with the smallest of their vectors. Other columns
    are not read; an empty table gives an empty result. Exact: recall is 1.
    """
    known = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("is_query"))
    known = known.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    known = known.groupBy("vec_id").agg(F.min("vector").alias("vector"), F.max("is_query").alias("is_query")).withColumn("dim", F.size("vector"))
    known = settle(known, "vectors")
    queries, query_blocks = _blocks(known.where("is_query"), QUERY_BLOCK, "queries")
    candidates, candidate_blocks = _blocks(known, CANDIDATE_BLOCK, "candidates")
    # every query block goes to each of a number of tasks, every candidate block to one task per query block
    tasks = min(candidate_blocks, max(1, 4 * known.sparkSession.sparkContext.defaultParallelism // query_blocks))
    query_side = queries.select("dim", F.col("block").alias("qb"), F.col("rows").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("part"))
    candidate_side = candidates.select(
        "dim", (F.col("block") % tasks).alias("part"), F.col("rows").alias("candidates"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb")
    )
    # the queries of a task are rows of their own kind, first in order, so that each block is sent and decoded once
    both = query_side.select("dim", "qb", "part", F.lit(0).alias("kind"), F.col("queries").alias("rows")).unionByName(
        candidate_side.select("dim", "qb", "part", F.lit(1).alias("kind"), F.col("candidates").alias("rows"))
    )
    dealt = both.repartition(max(1, query_blocks * tasks), "dim", "qb", "part").sortWithinPartitions("dim", "qb", "part", "kind")

    def matrix(rows: list) -> tuple[np.ndarray, np.ndarray]:
        return np.array([r["vec_id"] for r in rows], np.int64), np.array([r["vector"] for r in rows], np.float64)

    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, tile = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.kind == 0:
                    if tile is not None:
                        yield tile.rows()
                    key, tile = (row.dim, row.qb, row.part), Tile(*matrix(row.rows), k)
                elif key == (row.dim, row.qb, row.part):
                    tile.meet(*matrix(row.rows))
        if tile is not None:
            yield tile.rows()

    merged = dealt.mapInPandas(tiles, "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
