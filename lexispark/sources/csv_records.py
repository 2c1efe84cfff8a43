"""Records of CSV files whose quoted fields span lines, read by as many tasks as the files have splits.

Whether a line begins a record depends on the quotes before it in the file: an even number means that no field is open
(a doubled quote counts twice). So a first pass counts the quotes of each split, a prefix sum over the splits says which
begin inside a quoted field, and a second pass puts the lines of each record together. Only records that cross the end of
a split leave their task in parts, at most two parts for each split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.operators.scale import fits_broadcast, settle

_OUT = "file bigint, block bigint, part int, value string"
WHOLE, HEAD, TAIL = 0, 1, 2  # a record, the end of one that began in an earlier split, the beginning of one that goes on


class _Split:
    """Lines of one split, in order, put together to records."""

    def __init__(self, file: int, block: int, odd: bool):
        self.file, self.block, self.parity = file, block, int(odd)
        self.open: list[str] = []  # lines of the record that has not ended
        self.begun = not odd  # whether that record began in this split
        self.first = block == 0  # whether the next record is the file's header

    def records(self, lines: pa.Array) -> Iterator[tuple[int, str]]:
        quotes = pc.fill_null(pc.count_substring(lines, '"'), 0).to_numpy(zero_copy_only=False)
        after = (self.parity + np.cumsum(quotes)) % 2
        if len(after):
            self.parity = int(after[-1])
        ends = (after == 0).tolist()
        for line, ended in zip(lines.to_pylist(), ends):
            self.open.append(line)
            if ended:
                yield from self._take(WHOLE if self.begun else HEAD)
                self.begun = True

    def _take(self, part: int) -> Iterator[tuple[int, str]]:
        text, self.open = "\n".join(self.open), []
        if self.first and part == WHOLE:
            if text:
                self.first = False
            return
        if text or part != WHOLE:  # a blank line between records is none
            yield part, text

    def rest(self) -> Iterator[tuple[int, str]]:
        if self.open:
            yield from self._take(TAIL if self.begun else HEAD)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the text of each record of headed, UTF-8 CSV files, without the headers. Lines are joined by a line feed.

    A header must end within its file's first split.
    """
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select(*place, "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = settle(lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes")), "csv-splits")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    splits = settle(counts.select("file", "block", odd.alias("odd")).where("odd"), "csv-open-splits")
    splits = F.broadcast(splits) if fits_broadcast(splits) else splits.hint("shuffle_hash")
    marked = lines.join(splits, ["file", "block"], "left").select("file", "block", F.coalesce("odd", F.lit(False)).alias("odd"), "value")

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            file, block = (batch.column(c).to_numpy() for c in ("file", "block"))
            odd = batch.column("odd")
            change = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
            found: list[tuple[int, int, int, str]] = []
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if split is None or (split.file, split.block) != (int(file[a]), int(block[a])):
                    found += [(split.file, split.block, *x) for x in split.rest()] if split else []
                    split = _Split(int(file[a]), int(block[a]), odd[a].as_py())
                found += [(split.file, split.block, *x) for x in split.records(batch.column("value").slice(a, b - a))]
            if found:
                yield _batch(found)
        if split and (found := [(split.file, split.block, *x) for x in split.rest()]):
            yield _batch(found)

    def _batch(found: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
        file, block, part, value = zip(*found)
        return pa.RecordBatch.from_arrays(
            [pa.array(file, pa.int64()), pa.array(block, pa.int64()), pa.array(part, pa.int32()), pa.array(value, pa.string())], ["file", "block", "part", "value"]
        )

    made = settle(marked.mapInArrow(assembled, _OUT), "csv-records")
    # a record that crosses splits: its beginning, and all that follows up to the next beginning
    parts = made.where(F.col("part") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "part")
    number = F.sum((F.col("part") == TAIL).cast("int")).over(order)
    joined = parts.withColumn("number", number).groupBy("file", "number")
    crossing = joined.agg(F.array_join(F.sort_array(F.collect_list(F.struct("block", "part", "value")))["value"], "\n").alias("value"))
    return made.where(F.col("part") == WHOLE).select("value").unionByName(crossing.select("value"))
