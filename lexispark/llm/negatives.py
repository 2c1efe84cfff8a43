"""Hard negatives by segment summary filtering: bounds on inner products from the means and deviations of vector segments.

A segment of a vector keeps its mean m and its deviation d, the norm of the segment less its mean. Over a segment of n
components the inner product of x and y is ``n m m' `` give or take ``d d'``, so the sums over all segments bound it from
both sides. A tile starts with one segment for the whole vector and splits segments hierarchically; a pair goes on to the
next level only while its bounds leave it a chance, and what is left after the last level is scored exactly.

Candidates are dealt by a hash to parts of bounded size that stay in a task, and the few anchors are sent to every part
of their group; a task emits the best rows of each anchor in its part, and the parts' rows are merged by rank. A label
that holds a large share of all rows is many parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators.scale import lookup_join, settle

PART_BYTES = 32 << 20  # of vectors that a task keeps
LEAST_PART = 1024  # rows; smaller tables are not split further for more tasks
ANCHOR_TILE, CANDIDATE_TILE = 256, 1024
SPLIT = 4  # segments that one segment becomes on the next level
PAIRS = 1 << 21  # components of pairs that are gathered at once
SPARSE = 1 / 16  # share of pairs of a tile below which they are bounded one by one
IDLE = 0.9  # a level that leaves a larger share of the open pairs is passed over in the following tiles
_FULL = np.int64(2**63 - 1)
_FOUND = "anchor_id bigint, band int, vec_id bigint, score bigint"


def segment_starts(dim: int) -> list[np.ndarray]:
    """First component of each segment, per level: one segment, then ever more, down to segments of two components."""
    counts, n = [], 1
    while n < dim // 2:
        counts.append(n)
        n *= SPLIT
    if dim:
        counts.append(max(1, dim // 2))
    return [np.arange(n) * dim // n for n in counts]


@dataclass
class Rows:
    """Vectors of one length with their ids and labels. Codes are whole numbers, exact in double precision."""

    ids: np.ndarray
    labels: np.ndarray
    codes: np.ndarray

    @cached_property
    def levels(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level the segments' means, scaled by the root of their length, and their deviations."""
        found = []
        for starts in segment_starts(self.codes.shape[1]):
            length = np.diff(np.append(starts, self.codes.shape[1]))
            mean = np.add.reduceat(self.codes, starts, axis=1) / length
            off = self.codes - np.repeat(mean, length, axis=1)
            found.append((mean * np.sqrt(length), np.sqrt(np.add.reduceat(off * off, starts, axis=1))))
        return found

    @cached_property
    def norm(self) -> np.ndarray:
        return np.sqrt((self.codes * self.codes).sum(axis=1))

    def part(self, a: int, b: int) -> Rows:
        rows = Rows(self.ids[a:b], self.labels[a:b], self.codes[a:b])
        rows.levels = [(m[a:b], d[a:b]) for m, d in self.levels]
        rows.norm = self.norm[a:b]
        return rows


def _small(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether inner products of these whole numbers are exact in double precision."""
    return not a.size or not b.size or a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2**53


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers; beyond the range of 64 bits they stay at its ends."""
    if not a.size:
        return np.zeros(len(a), np.int64)
    if _small(a, b):
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    exact = (sum(int(x) * int(y) for x, y in zip(r, s)) for r, s in zip(a, b))
    return np.array([max(-int(_FULL), min(int(_FULL), x)) for x in exact], np.int64)


class Search:
    """A tile of anchors, each with bands of scores, that keeps the ``k`` best rows of each band it has met."""

    def __init__(self, anchors: Rows, low: np.ndarray, high: np.ndarray, k: int, same_label: bool):
        self.anchors, self.low, self.high, self.k, self.same = anchors, low, high, k, same_label
        self.bands = low.shape[1]
        # bounds know no end of the range at which scores stay
        self.from_, self.to = np.where(low == -_FULL, -np.inf, low.astype(float)), np.where(high == _FULL, np.inf, high.astype(float))
        self.best = [np.zeros(0, np.int64) for _ in range(3)]  # anchor and band, score, id; in order
        self.idle: set[int] = set()  # levels that left nearly all pairs of a tile open
        self.least = np.full(low.shape, -np.inf)  # k-th best score of each band so far, or a bound below it

    def _bounds(self, rows: Rows, level: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean, deviation = self.anchors.levels[level]
        m, d = rows.levels[level]
        step = max(1, PAIRS // m.shape[1])
        middle, around = np.empty(len(i)), np.empty(len(i))
        for a in range(0, len(i), step):
            x, y = i[a : a + step], j[a : a + step]
            middle[a : a + step] = np.einsum("ij,ij->i", mean[x], m[y])
            around[a : a + step] = np.einsum("ij,ij->i", deviation[x], d[y])
        return middle, around + 1e-10 * self.anchors.norm[i] * rows.norm[j]

    def _hull(self) -> tuple[np.ndarray, np.ndarray]:
        """Per anchor the least and the largest score that any of its bands still takes."""
        return np.maximum(self.from_, self.least).min(axis=1), self.to.max(axis=1)

    def _chance(self, low: np.ndarray, high: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Whether pairs of scores within the bounds can be among the best of a band of their anchor."""
        yes = np.zeros(low.shape, bool)
        for b in range(self.bands):
            yes |= (high >= np.maximum(self.from_[i, b], self.least[i, b])) & (low <= self.to[i, b])
        return yes

    def _raise(self, low: np.ndarray, high: np.ndarray, open_: np.ndarray) -> None:
        """From pairs that are certainly in a band, a bound below the k-th best score of a band with too few rows so far."""
        if low.shape[1] < self.k:
            return
        for b in range(self.bands):
            few = np.flatnonzero(np.isneginf(self.least[:, b]))
            if len(few):
                inside = open_[few] & (low[few] >= self.from_[few, b, None]) & (high[few] <= self.to[few, b, None])
                certain = np.where(inside, np.minimum(low[few], float(_FULL)), -np.inf)
                self.least[few, b] = np.partition(certain, -self.k, axis=1)[:, -self.k]

    def meet(self, rows: Rows) -> None:
        same = self.anchors.labels[:, None] == rows.labels[None, :]
        open_ = (same == self.same) & (self.anchors.ids[:, None] != rows.ids[None, :])
        left, pairs = np.count_nonzero(open_), None
        for level, (mean, deviation) in enumerate(rows.levels):
            if level in self.idle:
                continue
            if pairs is None and left >= SPARSE * open_.size:
                m, d = self.anchors.levels[level]
                middle, high = m @ mean.T, d @ deviation.T
                high += (1e-10 * self.anchors.norm)[:, None] * rows.norm[None, :]
                low = middle - high
                high += middle
                self._raise(low, high, open_)
                least, most = self._hull()
                open_ &= high >= least[:, None]
                open_ &= low <= most[:, None]
                now = np.count_nonzero(open_)
            else:
                pairs = np.nonzero(open_) if pairs is None else pairs
                middle, around = self._bounds(rows, level, *pairs)
                chance = self._chance(middle - around, middle + around, pairs[0])
                pairs = pairs[0][chance], pairs[1][chance]
                now = len(pairs[0])
            if level + 1 < len(rows.levels) and now > IDLE * left and not np.isneginf(self.least).any():
                self.idle.add(level)
            left = now
        if pairs is None and left >= SPARSE * open_.size and _small(self.anchors.codes, rows.codes):
            pairs = np.nonzero(open_)
            self._keep(rows, *pairs, (self.anchors.codes @ rows.codes.T)[pairs].astype(np.int64))
            return
        i, j = np.nonzero(open_) if pairs is None else pairs
        step = max(1, PAIRS // max(1, rows.codes.shape[1]))
        for a in range(0, len(i), step):
            x, y = i[a : a + step], j[a : a + step]
            self._keep(rows, x, y, products(self.anchors.codes[x], rows.codes[y]))

    def _keep(self, rows: Rows, i: np.ndarray, j: np.ndarray, score: np.ndarray) -> None:
        least, most = self._hull()
        within = (score >= least[i]) & (score <= most[i])
        i, j, score = i[within], j[within], score[within]
        for b in range(self.bands):
            inside = (score >= self.low[i, b]) & (score <= self.high[i, b]) & (score >= self.least[i, b])
            if not inside.any():
                continue
            new = (i[inside] * self.bands + b, score[inside], rows.ids[j[inside]])
            band, found, ids = (np.concatenate(both) for both in zip(self.best, new))
            order = np.lexsort((ids, -found, band))
            band, found, ids = band[order], found[order], ids[order]
            place = np.arange(len(band)) - np.searchsorted(band, band)
            first = place < self.k
            self.best = [band[first], found[first], ids[first]]
            full = place == self.k - 1
            self.least[band[full] // self.bands, band[full] % self.bands] = found[full]

    def found(self) -> pa.RecordBatch:
        band, score, ids = self.best
        columns = [self.anchors.ids[band // self.bands], (band % self.bands).astype(np.int32), ids, score]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["anchor_id", "band", "vec_id", "score"])


def _rows(batch: pa.RecordBatch, dim: int) -> Rows:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dim)
    most = np.finfo(np.float64).max
    return Rows(batch.column("id").to_numpy(), batch.column("label").to_numpy(), np.floor(256 * flat).clip(-most, most))


def _joined(parts: list[Rows]) -> Rows:
    return Rows(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("ids", "labels", "codes")))


def _best_in_parts(anchors: DataFrame, candidates: DataFrame, k: int, same_label: bool) -> DataFrame:
    """``(anchor_id, band, vec_id, score)``: at least the ``k`` best rows in each band of each anchor.

    ``anchors(grp, id, label, vector, low, high)`` meet the ``candidates(grp, id, label, vector)`` of their group.
    ``low`` and ``high`` are arrays with an entry for each band.
    """
    spark = candidates.sparkSession
    tasks = 4 * spark.sparkContext.defaultParallelism
    total = candidates.count()
    per_part = F.greatest(F.lit(1), F.floor(F.lit(PART_BYTES) / (8 * F.max(F.size("vector")) + 1)))
    by_size = F.ceil(F.count("*") / per_part)
    share = F.floor(F.least(F.lit(float(tasks)) / max(1, total), F.lit(1.0) / LEAST_PART) * F.count("*"))  # parts for all cores
    groups = settle(candidates.groupBy("grp").agg(F.greatest(by_size, share, F.lit(1)).cast("int").alias("parts")), "groups")
    keys = max(1, min(int(groups.agg(F.coalesce(F.sum("parts"), F.lit(1))).first()[0]), 1 << 20))
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    none = F.lit(None).cast("array<bigint>")
    resident = lookup_join(candidates, groups, "grp", ["id"]).select("grp", part.alias("part"), F.lit(0).alias("kind"), "id", "label", "vector", none.alias("low"), none.alias("high"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    sent = lookup_join(anchors, groups, "grp", ["id"]).select("grp", every.alias("part"), F.lit(1).alias("kind"), "id", "label", "vector", "low", "high")
    dealt = resident.unionByName(sent).repartition(keys, "grp", "part").sortWithinPartitions("grp", "part", "kind")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, index = None, [], None
        for batch in batches:
            grp, part_no, kind = batch.column("grp").to_pylist(), batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            at = 0
            while at < batch.num_rows:
                now, end = (grp[at], part_no[at]), at + 1
                while end < batch.num_rows and kind[end] == kind[at] and (grp[end], part_no[end]) == now:
                    end += 1
                rows = batch.slice(at, end - at)
                mine = _rows(rows, len(rows.column("vector")[0]))
                if now != key:
                    key, held, index = now, [], None
                if kind[at] == 0:
                    held.append(mine)
                elif held or index is not None:
                    if index is None:
                        index, held = _joined(held), []
                    bands = [np.array(rows.column(c).to_pylist(), np.int64) for c in ("low", "high")]
                    for a in range(0, len(mine.ids), ANCHOR_TILE):
                        b = min(a + ANCHOR_TILE, len(mine.ids))
                        search = Search(mine.part(a, b), *(x[a:b] for x in bands), k, same_label)
                        for c in range(0, len(index.ids), CANDIDATE_TILE):
                            search.meet(index.part(c, c + CANDIDATE_TILE))
                        yield search.found()
                at = end

    return dealt.mapInArrow(tiles, _FOUND)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hardest negatives within a band.

    Scores are inner products of the vectors whose components x are floor(256 * x). The positives of an anchor are its
    first rows of the same label, the negatives of a positive its first rows of another label whose score n is within
    low and high shares of the positive's score p: ``low[0] * p <= low[1] * n`` and ``high[1] * n <= high[0] * p``. Higher
    scores come first, ties by smaller id. A positive without such a row gives no row.

    Rows without id or label, with a null vector or one with a null or non-finite component take no part; vectors of
    different length do not meet. Rows that repeat an id count once, with the smallest label and vector. Scores beyond
    the range of a long stay at its ends. Other columns are not read; an empty table gives an empty result. Exact:
    recall is 1.
    """
    if not 0 <= low[0] <= low[1] or not 0 <= high[0] <= high[1]:
        raise ValueError("the shares are between 0 and 1")
    known = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"), F.struct(label.cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vector")).alias("v"), is_anchor.alias("anchor")
    )
    bad = F.exists("v.vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = known.where(F.col("id").isNotNull() & F.col("v.label").isNotNull() & F.col("v.vector").isNotNull() & ~bad)
    known = known.groupBy("id").agg(F.min("v").alias("v"), F.max("anchor").alias("anchor"))
    known = settle(known.select("id", "v.label", "v.vector", "anchor"), "labelled-vectors")

    def ranked(found: DataFrame, k: int) -> DataFrame:
        order = Window.partitionBy("anchor_id", "band").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    ends = [F.array(F.lit(x).cast("bigint")).alias(c) for c, x in (("low", -int(_FULL)), ("high", int(_FULL)))]
    of_label = known.withColumn("grp", F.concat_ws("/", F.size("vector"), "label"))
    found = _best_in_parts(of_label.where("anchor").select("grp", "id", "label", "vector", *ends), of_label.select("grp", "id", "label", "vector"), positives, True)
    near = settle(ranked(found, positives).select("anchor_id", "vec_id", "score", "rank"), "positives")

    # whole bounds of each band; decimals, as products of a long do not fit one
    p = F.col("score").cast("decimal(19,0)")
    bounds = F.struct("rank", "vec_id", "score", F.ceil(p * low[0] / low[1]).cast("bigint").alias("low"), F.floor(p * high[0] / high[1]).cast("bigint").alias("high"))
    bands = settle(near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(bounds)).alias("bands")), "bands")  # not longer than positives

    def padded(column: str, empty: int) -> Column:
        """An end of each band; bands of missing positives hold no score."""
        every = F.sequence(F.lit(0), F.lit(positives - 1))
        return F.transform(every, lambda i: F.coalesce(F.get(F.col("bands")[column], i), F.lit(empty).cast("bigint"))).alias(column)

    everyone = known.withColumn("grp", F.size("vector").cast("string")).select("grp", "id", "label", "vector")
    asking = everyone.join(bands, F.col("id") == F.col("anchor_id")).select("grp", "id", "label", "vector", padded("low", int(_FULL)), padded("high", -int(_FULL)))
    found = ranked(_best_in_parts(asking, everyone, negatives, False), negatives)
    named = near.select("anchor_id", (F.col("rank") - 1).alias("band"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["anchor_id", "band"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
