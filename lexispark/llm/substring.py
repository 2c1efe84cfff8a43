"""Removal of word windows that an earlier document already holds, with a count-min sketch in front of the exact work.

Every window of ``window`` words has an anchor: the smallest hash among the word runs of half its length inside it. Equal
windows have equal anchors, so the number of documents with a window is at most the number with its anchor, and neighbouring
windows mostly share theirs (about one anchor for 13 windows of 50 words).

1. Each partition sketches the anchors of its documents; the merged sketch overestimates the documents per anchor and so
   per window.
2. A second pass keeps documents with a window whose estimate is two or more. All others are finished.
3. Exact, by 128-bit fingerprints: runs of windows with one anchor are grouped first. A run that an earlier document
   holds is removed. Only the windows of the remaining runs are grouped one by one; the first holder of every run is
   among them, so no source is lost.
4. The kept documents are read with their marks, and the words left are joined and hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.sketch import bits_for, merged, reached
from lexispark.llm.words import LANES, Words, grams, mix, signed, slices, sliding_min
from lexispark.operators.scale import settle

# Sketch size: cells for each expected anchor, and the bounds of the cells per row as powers of two. Beyond the upper
# bound (2 x 16 MiB) the sketch lets more windows through to the exact passes; the result is the same.
CELLS_PER_ANCHOR = 8
LEAST_BITS, MOST_BITS = 16, 27


def _anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of each window start of the slice, and which starts have their whole window in one row."""
    half = (window + 1) // 2
    runs = mix(grams(words.lanes[0], half, LANES[0]))
    anchor = sliding_min(runs, window - half + 1)
    return anchor, words.row[: len(anchor)] == words.row[window - 1 :] if len(anchor) else np.zeros(0, bool)


def _runs(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start and anchor of each maximal run of windows with one anchor in one row."""
    anchor, whole = _anchors(words, window)
    if not whole.any():
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    fresh = np.ones(len(anchor), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (words.row[1 : len(anchor)] != words.row[: len(anchor) - 1]) | ~whole[:-1]
    a = np.flatnonzero(fresh & whole)
    after = np.append(np.flatnonzero(fresh | ~whole), len(anchor))
    b = after[np.searchsorted(after, a, "right")] - 1
    # periodic text can carry one anchor on: cut so that the first and the last window cover the whole run
    longest = window // 2
    if len(a) and (b - a).max() >= longest:
        pieces = (b - a) // longest + 1
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(a, pieces) + number * longest
        b = np.minimum(begin + longest - 1, np.repeat(b, pieces))
        a = begin
    return a, b, anchor[a]


def _expected_anchors(docs: DataFrame, window: int) -> float:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return size / 6 * 4 / window


def _first_holders(keys: DataFrame) -> DataFrame:
    """``keys(k1, k2, doc_id, ...)`` with ``earlier``: a smaller doc_id has the same key. Map-side minima first."""
    least = keys.groupBy("k1", "k2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    least = least.where("least < most").drop("most")
    return keys.join(least, ["k1", "k2"], "left").withColumn("earlier", F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False)))


def _text_hash(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def remove_repeats(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, if asked for, the kept words as ``kept``.

    Removed is each word covered by a window of ``window`` words that also starts in a row with a smaller key; windows
    are judged on the input. Null and empty texts have no words; texts shorter than a window keep all of them. Rows
    without a key keep all words and remove none from others. Rows with one key do not remove words from each other.
    An empty table gives an empty result; other columns of ``docs`` are not read.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    spark = docs.sparkSession
    bits = bits_for(_expected_anchors(docs, window), CELLS_PER_ANCHOR, LEAST_BITS, MOST_BITS)

    def sketched(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
        for words in slices(batch.column("text"), lanes=1):
            a, _, anchor = _runs(words, window)
            row = words.row[a]
            keep = known[words.first + row]
            row, anchor = row[keep], anchor[keep]
            order = np.lexsort((anchor, row))  # a document counts once for each anchor
            row, anchor = row[order], anchor[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
            yield anchor[fresh]

    sketch = spark.sparkContext.broadcast(merged(docs, sketched, bits, at_least=2))

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for words in slices(batch.column("text"), lanes=1):
                a, _, anchor = _runs(words, window)
                hits = np.zeros(words.rows, bool)
                hits[words.row[a[reached(sketch.value, anchor, bits)]]] = True
                bounds, data = words.bounds(), words.data.tobytes()
                rows = {n: [] for n in ("row", "doc_id", "n_words", "n_removed", "kept_sha256", "kept", "text")}
                for i in range(words.rows):
                    at = slice(bounds[i], bounds[i + 1])
                    found = [data[s:e] for s, e in zip(words.start[at].tolist(), words.end[at].tolist())]
                    doc_id = ids[words.first + i]
                    open_ = bool(hits[i]) and doc_id is not None
                    joined = b" ".join(found)
                    rows["row"].append(number)
                    rows["doc_id"].append(doc_id)
                    rows["n_words"].append(len(found))
                    rows["n_removed"].append(0)
                    rows["kept_sha256"].append(None if open_ else hashlib.sha256(joined).hexdigest())
                    rows["kept"].append(joined.decode() if with_text and not open_ else None)
                    rows["text"].append(joined.decode() if open_ else None)
                    number += 1
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))

    columns = "row bigint, doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string, text string"
    passed = settle(docs.mapInArrow(filtered, columns), "windows")
    open_docs = passed.where("text is not null").select("row", "doc_id", "text")

    def run_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for words in slices(batch.column("text")):
                a, b, anchor = _runs(words, window)
                keep = reached(sketch.value, anchor, bits)
                a, b = a[keep], b[keep]
                if not len(a):
                    continue
                at = words.row[a]
                length = (b - a).astype(np.uint64)
                keys = []
                for lane, multiplier in zip(words.lanes, LANES):
                    fp = grams(lane, window, multiplier)
                    keys.append(signed(mix(mix(fp[a]) * np.uint64(multiplier) + mix(fp[b] + length))))
                first = a - words.bounds()[at]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(ids[words.first + at]), pa.array(rows[words.first + at]), pa.array(first.astype(np.int32)), pa.array((b - a + 1).astype(np.int32))],
                    ["k1", "k2", "doc_id", "row", "first", "n"],
                )

    runs = open_docs.mapInArrow(run_keys, "k1 bigint, k2 bigint, doc_id bigint, row bigint, first int, n int")
    judged = settle(_first_holders(runs).select("row", "first", "n", "earlier"), "runs")
    sketch.destroy()
    left = judged.where("not earlier").groupBy("row").agg(F.collect_list(F.struct("first", "n")).alias("left"))

    def window_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            ranges = batch.column("left")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ranges.offsets.to_numpy()))
            flat = ranges.flatten()
            first, n = flat.field("first").to_numpy(), flat.field("n").to_numpy()
            for words in slices(batch.column("text")):
                mine = np.flatnonzero((owner >= words.first) & (owner < words.first + words.rows))
                if not len(mine):
                    continue
                at = owner[mine] - words.first
                size = n[mine].astype(np.int64)
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                begin = np.repeat(first[mine].astype(np.int64), size) + inside
                at = np.repeat(at, size)
                place = words.bounds()[at] + begin
                keys = [signed(mix(grams(lane, window, m)[place])) for lane, m in zip(words.lanes, LANES)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, pa.array(ids[words.first + at]), pa.array(rows[words.first + at]), pa.array(begin.astype(np.int32))],
                    ["k1", "k2", "doc_id", "row", "first"],
                )

    single = open_docs.join(left, "row").mapInArrow(window_keys, "k1 bigint, k2 bigint, doc_id bigint, row bigint, first int")
    again = _first_holders(single).where("earlier").select("row", "first", F.lit(1).alias("n"))
    marks = judged.where("earlier").select("row", "first", "n").unionByName(again)
    marks = marks.groupBy("row").agg(F.collect_list(F.struct("first", "n")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, body, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "marks"))):
                found = body.encode().split()
                change = np.zeros(len(found) + 1, np.int32)
                for x in ranges or ():
                    change[x["first"]] += 1
                    change[x["first"] + x["n"] + window - 1] -= 1
                gone = np.cumsum(change[:-1]) > 0
                kept = [w for w, g in zip(found, gone.tolist()) if not g] if gone.any() else found
                out.append((doc_id, len(found), int(gone.sum()), _text_hash(kept), b" ".join(kept).decode() if with_text else None))
            arrays = [pa.array(list(v), k) for v, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
            if out:
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
    finished = passed.where("text is null").select(*names)
    cut_docs = open_docs.join(marks, "row", "left").select("doc_id", "text", "marks").mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")
    result = finished.unionByName(cut_docs)
    return result if with_text else result.drop("kept")
