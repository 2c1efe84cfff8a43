"""Words and word-sequence fingerprints of whole texts, computed on the buffers of Arrow batches.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return, in UTF-8. All
functions work on a slice of a batch with a bounded number of bytes (a single longer text is a slice of its own), so a
task's memory does not depend on the number of rows in its batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 1 << 20
LONG_WORD = 64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# odd multipliers of the two fingerprint lanes
LANES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@dataclass
class Words:
    """The words of some consecutive rows. ``row`` counts from ``first``; ``lanes`` holds two 64-bit hashes per word."""

    first: int
    rows: int
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    lanes: tuple[np.ndarray, ...]

    def bounds(self) -> np.ndarray:
        """Word number at which each row begins, and the number of words at the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values after which all bits are well spread."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lanes: int) -> tuple[np.ndarray, ...]:
    length = end - start
    out = [np.full(len(start), 0x51ED27 + i, np.uint64) for i in range(lanes)]
    active, step = np.flatnonzero(length <= LONG_WORD), 0
    while len(active):
        byte = data[start[active] + step].astype(np.uint64)
        for i, multiplier in enumerate(LANES[:lanes]):
            out[i][active] = out[i][active] * np.uint64(multiplier) + byte + np.uint64(1)
        step += 1
        active = active[length[active] > step]
    for w in np.flatnonzero(length > LONG_WORD):
        whole = xxhash.xxh3_128_intdigest(data[start[w] : end[w]].tobytes())
        for i in range(lanes):
            out[i][w] = (whole >> (64 * i)) & 0xFFFFFFFFFFFFFFFF
    return tuple(mix(x) for x in out)


def slices(text: pa.Array, lower: bool = False, lanes: int = 2) -> Iterator[Words]:
    """Words of a text column, slice by slice. Null texts have no words."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(text):
        before = int(ends[first - 1]) if first else 0
        last = min(max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))), len(text))
        # only a slice is ever copied, not the batch
        held = pc.fill_null(text.slice(first, last - first).cast(pa.large_string()), "")
        _, offsets, data = held.buffers()
        offsets = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        part, at = data[offsets[0] : offsets[-1]], offsets - offsets[0]
        if lower:
            part = _LOWER[part]
        inside = ~_SEPARATOR[part]
        fresh = np.ones(len(part) + 1, bool)  # no word goes on from the byte before
        fresh[1:-1] = ~inside[:-1] if len(part) else fresh[1:-1]
        fresh[at] = True
        start = np.flatnonzero(inside & fresh[:-1])
        closing = np.ones(len(part), bool)
        if len(part):
            closing[:-1] = ~inside[1:] | fresh[1:-1] & inside[1:]
        end = np.flatnonzero(inside & closing) + 1
        row = np.searchsorted(at, start, "right") - 1
        yield Words(first, last - first, part, start, end, row, _hashes(part, start, end, lanes))
        first = last


def grams(hashes: np.ndarray, n: int, multiplier: int) -> np.ndarray:
    """Fingerprint of every run of ``n`` consecutive hashes, by doubling; fewer than ``n`` hashes give none."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    block, size, whole, done, rest = hashes, 1, None, 0, n
    while rest:
        if rest & 1:
            if whole is None:
                whole, done = block, size
            else:
                count = len(hashes) - done - size + 1
                whole = whole[:count] * np.uint64(pow(multiplier, size, 1 << 64)) + block[done : done + count]
                done += size
        rest >>= 1
        if rest:
            count = len(block) - size
            block = block[:count] * np.uint64(pow(multiplier, size, 1 << 64)) + block[size : size + count]
            size *= 2
    return whole


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values."""
    if len(values) < width:
        return values[:0]
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
