"""Count-min sketches of hashes over a whole table: one sparse sketch per partition, merged block by block.

The hashes of a partition fall into ``2**bits`` cells of ``DEPTH`` rows. What leaves a task is one compressed message per
row and block of cells for every million hashes, a few hundred messages at a time. The merge deals the blocks to tasks, which add up the messages as they stream in; nothing but
the merged sketch, whose size is fixed by ``bits``, reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexispark.llm.words import mix

DEPTH = 2
BLOCK_BITS = 16
HELD = 1 << 20  # hashes that a task gathers before it sends messages
MESSAGES = 256  # that leave a task in one batch
_ROWS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
_MESSAGE = "block int, data binary"


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mix(hashes * _ROWS[row]) >> np.uint64(64 - bits)).astype(np.int64)


def bits_for(items: float, per_item: float, least: int, most: int) -> int:
    """Cells per row as a power of two: ``per_item`` cells for each item, within fixed bounds."""
    return int(min(most, max(least, np.ceil(np.log2(max(1.0, items * per_item))))))


def _messages(parts: list[list[np.ndarray]], bits: int) -> Iterator[tuple[int, bytes]]:
    blocks = 1 << max(0, bits - BLOCK_BITS)
    for row, found in enumerate(parts):
        if not found:
            continue
        cell, count = np.unique(np.concatenate(found), return_counts=True)
        found.clear()
        ends = np.searchsorted(cell, np.arange(blocks + 1, dtype=np.int64) << BLOCK_BITS)
        for block in range(blocks):
            a, b = ends[block], ends[block + 1]
            if a < b:
                yield row * blocks + block, _encoded(cell[a:b] & ((1 << BLOCK_BITS) - 1), count[a:b])


def _encoded(cell: np.ndarray, count: np.ndarray) -> bytes:
    """Rising cells of a block as differences, and their counts."""
    inside = cell.astype(np.uint16)
    inside[1:] -= inside[:-1].copy()
    return zlib.compress(inside.tobytes() + count.astype(np.uint32).tobytes(), 1)


def _whole(totals: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """Messages of a task that has counted all its cells."""
    for number, block in enumerate(totals.reshape(-1, 1 << min(bits, BLOCK_BITS))):
        cell = np.flatnonzero(block)
        if len(cell):
            yield number, _encoded(cell, block[cell])


def _sent(messages: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    while some := list(islice(messages, MESSAGES)):
        block, data = zip(*some)
        yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(data, pa.binary())], ["block", "data"])


def merged(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, at_least: int | None = None) -> np.ndarray:
    """The merged sketch of the hashes that ``hashes`` yields for each batch of ``df``.

    With ``at_least`` a packed bit per cell, set where the count reaches it; else the counts as 32-bit numbers. Shape:
    (DEPTH, cells or bytes of cells).
    """

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[] for _ in range(DEPTH)]
        held = 0
        for batch in batches:
            for part in hashes(batch):
                for row in range(DEPTH):
                    parts[row].append(cells(part, row, bits).astype(np.uint32))
                held += len(part)
                if held > HELD:
                    yield from _sent(_messages(parts, bits))
                    parts, held = [[] for _ in range(DEPTH)], 0
        yield from _sent(_messages(parts, bits))

    return _added(df, partition, bits, at_least)


def counted(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> np.ndarray:
    """As ``merged`` without a bound, for a small sketch: each task holds all cells and sends them once, at its end."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((DEPTH, 1 << bits), np.uint32)
        for batch in batches:
            for part in hashes(batch):
                for row in range(DEPTH):
                    np.add.at(totals[row], cells(part, row, bits), np.uint32(1))
        yield from _sent(_whole(totals, bits))

    return _added(df, partition, bits, None)


def _added(df: DataFrame, partition: Callable, bits: int, at_least: int | None) -> np.ndarray:
    """The sum of the messages that ``partition`` makes of each partition."""
    width = 1 << min(bits, BLOCK_BITS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                body = zlib.decompress(data)
                n = len(body) // 6
                cell = np.cumsum(np.frombuffer(body, np.uint16, n), dtype=np.uint16)
                if block not in sums:
                    sums[block] = np.zeros(width, np.uint32 if at_least is None else np.uint8)
                total = sums[block]
                new = total[cell].astype(np.uint64) + np.frombuffer(body, np.uint32, n, 2 * n)
                total[cell] = np.minimum(new, np.iinfo(total.dtype).max)  # a full counter stays full
        for block, total in sums.items():
            data = total.tobytes() if at_least is None else np.packbits(total >= at_least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(data, 1)], pa.binary())], ["block", "data"])

    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.mapInArrow(partition, _MESSAGE).repartition(tasks, "block").mapInArrow(add, _MESSAGE).collect()  # bounded by the size of the sketch
    size = (1 << bits) * 4 if at_least is None else max(1, (1 << bits) // 8)
    whole = np.zeros((DEPTH, size), np.uint8)
    blocks = 1 << max(0, bits - BLOCK_BITS)
    per = size // blocks
    for block, data in rows:
        row, number = divmod(block, blocks)
        whole[row, number * per : (number + 1) * per] = np.frombuffer(zlib.decompress(bytes(data)), np.uint8)
    return whole.view(np.uint32) if at_least is None else whole


def reached(sketch: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether the estimated count of each hash reaches the bound that the packed sketch was built with."""
    yes = np.ones(len(hashes), bool)
    for row in range(DEPTH):
        cell = cells(hashes, row, bits)
        yes &= (sketch[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
    return yes


def estimated(sketch: np.ndarray, hashes: np.ndarray, bits: int, noise: float) -> np.ndarray:
    """Count estimates: the smallest cell, less what other hashes put into a cell on average; 1 at least."""
    least = sketch[0][cells(hashes, 0, bits)]
    for row in range(1, DEPTH):
        least = np.minimum(least, sketch[row][cells(hashes, row, bits)])
    return np.maximum(1.0, least - noise)
