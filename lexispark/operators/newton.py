"""Linear support vector machine with squared hinge loss: a distributed trust-region Newton method.

    minimise  |w|^2 / 2 + C * sum(max(0, 1 - y (w . x))^2),    x with a last feature 1, whose weight is the intercept

The rows are turned into blocks of compressed sparse rows once. Every pass over them adds up either the loss and its
gradient or a product of the Hessian and a vector, per partition, then in a tree, so that one vector reaches the driver
however many partitions there are. The Newton step inside the trust region comes from conjugate gradients.

The objective minus |w|^2 / 2 is convex, so a gradient of length e is at most e away from the best weights: ``tol`` bounds the
error of the weights themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

# arrays as bytes, which reach a Python worker whole and not number by number
_BLOCK = "y binary, at binary, idx binary, value binary"
_KINDS = np.float64, np.int32, np.int32, np.float64
_PART = "loss double, part array<double>"
TASK_ROWS = 20_000
DIRECT = 16  # so many partial sums are added up by one task of a tree; one sum goes to the driver

# acceptance and growth of the trust region
_ACCEPT, _POOR, _GOOD = 1e-4, 0.25, 0.75
_SHRINK, _LESS, _GROW = 0.25, 0.5, 4.0


def blocks(train: DataFrame, label: str, features: str) -> DataFrame:
    """One row for each batch of rows: labels as -1 and 1, row starts, indices and values. Sparse or dense vectors."""
    stored = F.unwrap_udt(features)
    indices = F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(stored["values"]) - 1))
    rows = train.select((2.0 * F.col(label) - 1.0).alias("y"), indices.alias("idx"), stored["values"].alias("value"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                idx = batch.column("idx")
                length = np.diff(idx.offsets.to_numpy())
                arrays = [batch.column("y"), np.concatenate([[0], np.cumsum(length)]), idx.flatten(), batch.column("value").flatten()]
                whole = [pa.array([np.asarray(x, kind).tobytes()], pa.binary()) for x, kind in zip(arrays, _KINDS)]
                yield pa.RecordBatch.from_arrays(whole, ["y", "at", "idx", "value"])

    return rows.mapInArrow(packed, _BLOCK)


class Block:
    """Rows of a block: products with a vector, and of the rows with a weight for each."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.y, at, self.idx, self.value = (np.frombuffer(batch.column(i)[row].as_buffer(), kind) for i, kind in enumerate(_KINDS))
        self.row = np.repeat(np.arange(len(self.y)), np.diff(at))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.idx], minlength=len(self.y)) + w[-1]

    def weighted(self, by: np.ndarray, size: int) -> np.ndarray:
        total = np.bincount(self.idx, weights=self.value * by[self.row], minlength=size)
        total[-1] += by.sum()
        return total


def _added(parts: DataFrame, partitions: int, size: int) -> tuple[float, np.ndarray]:
    """The sum of the partial sums of all partitions."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, total = 0.0, np.zeros(size)
        for batch in batches:
            for row in range(batch.num_rows):
                loss += batch.column(0)[row].as_py()
                total += batch.column(1)[row].values.to_numpy()
        yield _part(loss, total)

    while partitions > 1:
        partitions = -(-partitions // DIRECT)
        parts = parts.repartition(partitions).mapInArrow(add, _PART)
    table = parts.toArrow()
    vectors = [table["part"][i].values.to_numpy() for i in range(table.num_rows)]
    return sum(table["loss"].to_pylist()), np.sum(vectors, axis=0) if vectors else np.zeros(size)


def _part(loss: float, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([loss]), pa.ListArray.from_arrays(pa.array([0, len(total)], pa.int32()), pa.array(total))], ["loss", "part"])


class Rows:
    """The objective over blocks at hand; what a margin was is kept for the products that follow at the same weights."""

    def __init__(self, held: list[Block], size: int, C: float):
        self.held, self.size, self.C = held, size, C
        self.active: list[np.ndarray] = []

    def at(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Value and gradient."""
        loss, total = 0.0, np.zeros(self.size)
        self.tried = [np.maximum(0.0, 1.0 - block.y * block.times(w)) for block in self.held]
        for block, short in zip(self.held, self.tried):
            loss += float(short @ short)
            total += block.weighted(-2.0 * block.y * short, self.size)
        return 0.5 * float(w @ w) + self.C * loss, w + self.C * total

    def bent(self, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The Hessian at ``w``, where ``settle`` was called last, times ``v``: rows within their margin take no part."""
        total = np.zeros(self.size)
        for block, active in zip(self.held, self.active):
            total += block.weighted(2.0 * active * block.times(v), self.size)
        return v + self.C * total

    def settle(self) -> None:
        """The weights of the last ``at`` are those of the products that follow."""
        self.active = [short > 0 for short in self.tried]


class SquaredHinge:
    """The objective over a persisted table of blocks, one pass over it for each value or product."""

    def __init__(self, table: DataFrame, size: int, C: float):
        self.table, self.size, self.C = table, size, C
        self.partitions = table.rdd.getNumPartitions()

    def _pass(self, sent: tuple, of: Callable) -> tuple[float, np.ndarray]:
        size, held = self.size, self.table.sparkSession.sparkContext.broadcast(sent)

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, total = 0.0, np.zeros(size)
            for batch in batches:
                for row in range(batch.num_rows):
                    more, part = of(Block(batch, row), size, *held.value)
                    loss, total = loss + more, total + part
            yield _part(loss, total)

        found = _added(self.table.mapInArrow(summed, _PART), self.partitions, self.size)
        held.unpersist()
        return found

    def at(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        """Value and gradient."""

        def of(block: Block, size: int, w: np.ndarray) -> tuple[float, np.ndarray]:
            short = np.maximum(0.0, 1.0 - block.y * block.times(w))
            return float(short @ short), block.weighted(-2.0 * block.y * short, size)

        loss, part = self._pass((w,), of)
        return 0.5 * float(w @ w) + self.C * loss, w + self.C * part

    def bent(self, w: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The Hessian at ``w`` times ``v``: rows within their margin take no part."""

        def of(block: Block, size: int, w: np.ndarray, v: np.ndarray) -> tuple[float, np.ndarray]:
            active = block.y * block.times(w) < 1.0
            return 0.0, block.weighted(2.0 * active * block.times(v), size)

        return v + self.C * self._pass((w, v), of)[1]

    def settle(self) -> None:
        """Nothing is kept between passes."""


def _step(gradient: np.ndarray, times: Callable, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """A step that lowers the quadratic model, by conjugate gradients up to the edge of the region, and what it leaves of
    the negative gradient."""
    step, rest = np.zeros_like(gradient), -gradient
    towards, square = rest.copy(), float(rest @ rest)
    enough = 0.1 * square**0.5
    while square**0.5 > enough:
        bent = times(towards)
        length = square / float(towards @ bent)
        ahead = step + length * towards
        if float(ahead @ ahead) > radius * radius:  # as far as the edge
            a, b, c = float(towards @ towards), float(step @ towards), float(step @ step) - radius * radius
            length = (-b + (b * b - a * c) ** 0.5) / a
            return step + length * towards, rest - length * bent
        step, rest = ahead, rest - length * bent
        before, square = square, float(rest @ rest)
        towards = rest + square / before * towards
    return step, rest


def minimise(objective: Rows | SquaredHinge, tol: float, max_iter: int) -> np.ndarray:
    """Weights whose gradient is not longer than ``tol``, or those after ``max_iter`` steps."""
    w = np.zeros(objective.size)
    value, gradient = objective.at(w)
    objective.settle()
    radius = float(np.linalg.norm(gradient))
    for _ in range(max_iter):
        if float(np.linalg.norm(gradient)) <= tol:
            break
        step, rest = _step(gradient, lambda v: objective.bent(w, v), radius)  # noqa: B023
        hoped = 0.5 * float(step @ rest - gradient @ step)
        then, new_gradient = objective.at(w + step)
        won, length = value - then, float(np.linalg.norm(step))
        slack = 1e-12 * max(1.0, abs(value))  # rounding of sums hides smaller gains
        if won < _POOR * hoped - slack:
            radius = max(_SHRINK * min(length, radius), _LESS * _SHRINK * radius) if won < _ACCEPT * hoped else _LESS * radius
        elif won > _GOOD * hoped:
            radius = max(radius, min(_GROW * length, _GROW * radius))
        if won >= _ACCEPT * hoped - slack:
            w, value, gradient = w + step, then, new_gradient
            objective.settle()
        elif radius < 1e-15:
            break
    return w


def fit_squared_hinge(
    train: DataFrame, size: int, rows: int, C: float = 1.0, max_iter: int = 1000, label: str = "label", features: str = "features", tol: float = 5e-4
) -> np.ndarray:
    """Weights of the ``size`` features and, last, the intercept. Labels are 0 and 1.

    ``rows`` is the number of rows. Up to ``TASK_ROWS`` all steps are made inside one task, which holds them; a job for each
    pass over so few rows would cost far more than the pass. The steps are the same.
    """
    table = blocks(train, label, features)
    if rows <= TASK_ROWS:

        def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [Block(batch, row) for batch in batches for row in range(batch.num_rows)]
            yield _part(0.0, minimise(Rows(held, size + 1, C), tol, max_iter))

        return table.coalesce(1).mapInArrow(solved, _PART).toArrow()["part"][0].values.to_numpy()
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return minimise(SquaredHinge(table, size + 1, C), tol, max_iter)
    finally:
        table.unpersist()
