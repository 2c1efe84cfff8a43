"""Best-fit packing of token sequences into bins of several permitted lengths.

Sequences longer than the largest length are cut into pieces; nothing is lost. The pieces are dealt by a hash to shards of
bounded expected size, and every shard is packed by itself: longest piece first, each into the open bin it fills best.
A piece that fits no open bin opens one. Which sizes are opened is optimised jointly: a shard is packed once for each
smallest size that may be opened, every bin is then downsized to the smallest permitted length that holds its contents,
and the packing of least cost stays. A bin of length L costs ``L + quadratic * L * L``, as a training step does.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LENGTHS = (512, 1024, 2048, 4096)
QUADRATIC = 1 / 16384
SHARD_PIECES = 20_000
_PACKED = "doc_id bigint, piece int, start bigint, n_tokens int, bin_id string, bin_length int, position int"


def cost(length: int, quadratic: float) -> float:
    return length + quadratic * length * length


def best_fit(sizes: list[int], lengths: tuple[int, ...], least_open: int) -> tuple[list[int], list[int]]:
    """Bin of each size (sizes in falling order), and what each bin holds. New bins have at least ``least_open`` room."""
    where, used, room = [], [], []
    by_room: dict[int, list[int]] = {}
    free = 0  # bit r is set while a bin with room r is open
    for size in sizes:
        fitting = free >> size
        if fitting:
            left = size + ((fitting & -fitting).bit_length() - 1)
            bins = by_room[left]
            b = bins.pop()
            if not bins:
                free &= ~(1 << left)
        else:
            b = len(used)
            used.append(0)
            room.append(next(x for x in lengths if x >= max(size, least_open)))
        used[b] += size
        left = room[b] - used[b]
        if left:
            by_room.setdefault(left, []).append(b)
            free |= 1 << left
        where.append(b)
    return where, used


def pack_sizes(sizes: list[int], lengths: tuple[int, ...], quadratic: float) -> tuple[list[int], list[int]]:
    """The cheapest packing over all smallest sizes to open: bin of each size, and the length of each bin after downsizing."""
    best = None
    for least_open in lengths:
        where, used = best_fit(sizes, lengths, least_open)
        final = [next(x for x in lengths if x >= u) for u in used]
        total = sum(cost(x, quadratic) for x in final)
        if best is None or total < best[0]:
            best = (total, where, final)
    return best[1], best[2]


def word_count(text: Column) -> Column:
    """Words of a text; none in a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def pack(docs: DataFrame, n_tokens: Column, lengths: tuple[int, ...] = LENGTHS, quadratic: float = QUADRATIC, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, bin_id, bin_length, position.

    ``n_tokens`` is the token count of a row of ``docs``; of its columns only doc_id and those in ``n_tokens`` are read.
    Pieces of a document are numbered from 0 and start at token ``start``; ``position`` is the piece's first token in its
    bin. Rows with no tokens or a null count need no room and give no piece. Rows without doc_id are packed under a null
    one, rows with the same doc_id each by itself; equal pieces are interchangeable. An empty table gives an empty
    result. The packing depends on the rows alone, not on partitions or the cluster.
    """
    lengths = tuple(sorted(set(lengths)))
    if not lengths or lengths[0] < 1:
        raise ValueError("lengths are positive")
    most = lengths[-1]
    counted = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), n_tokens.cast("bigint").alias("n")).where("n > 0")
    cut = counted.select("doc_id", "n", F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(most).cast("bigint"))).alias("piece", "start"))
    cut = cut.select("doc_id", "piece", "start", F.least(F.lit(most), F.col("n") - F.col("start")).cast("int").alias("n_tokens"))
    total = counted.agg(F.coalesce(F.sum(F.ceil(F.col("n") / most)), F.lit(0))).first()[0]
    shards = 1 + int(total) // shard_pieces
    # a document repeated without end still has its copies dealt by their sizes only, so a random-looking spread needs the id
    shard = F.pmod(F.xxhash64("doc_id", "piece", "n_tokens"), F.lit(shards)).cast("int")

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        where, final = pack_sizes(rows["n_tokens"].tolist(), lengths, quadratic)
        rows["bin_id"] = [f"{key[0]}-{b}" for b in where]
        rows["bin_length"] = [final[b] for b in where]
        rows["position"] = rows.groupby("bin_id")["n_tokens"].cumsum() - rows["n_tokens"]
        return rows[["doc_id", "piece", "start", "n_tokens", "bin_id", "bin_length", "position"]].astype({"doc_id": "Int64", "position": "int32"})

    return cut.withColumn("shard", shard).groupBy("shard").applyInPandas(packed, _PACKED)
