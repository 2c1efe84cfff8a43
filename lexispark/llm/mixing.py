"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks, then a seeded choice of blocks.

The documents of a source are dealt by a seeded hash to shards of about ``SHARD_TOKENS`` tokens, and a shard's documents,
in a seeded order, are one stream that is cut into blocks of ``BLOCK_TOKENS`` tokens (the last one may be shorter). The
blocks of the whole mix are allocated to the sources by the highest quotients target / (2 k - 1), and a source's blocks to
its shards by the highest quotients of their sizes. A shard then takes its blocks in a seeded order, and those of the first
places once more if its quota is larger than its number of blocks. What a document gives is the share of its tokens in
the blocks that were taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.operators.scale import lookup_join, number_rows, running_totals, settle

WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # tokens of the mix for tokens of all documents
MOST_EPOCHS = 2
BLOCK_TOKENS = 16
SHARD_TOKENS = 1_000_000
COPIES_AT_ONCE = 10_000


def seeded(*parts: Column | int) -> Column:
    """A number from the first 32 bits of a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])), 1, 8), 16, 10).cast("bigint")


def seats(claims: DataFrame, group: Sequence[str], weight: str, order: Sequence[Column], total: str, out: str = "quota") -> DataFrame:
    """Sainte-Laguë: ``claims`` with the number of seats of each claim, out of ``total`` seats of its group.

    Seats go to the highest quotients weight / (2 k - 1), ties in ``order``. With T the sum of the n weights and N seats, a
    claim of weight w has w / (2 q) give or take half a seat above the quotient q, so the last quotient with a seat is
    between T / (2 N + n) and T / (2 N - n). Only quotients in between are ranked, two for a claim on average; no claim's
    seats are listed. Claims of weight 0 get none. Weights must be positive somewhere in a group.
    """
    group = list(group)
    claims = settle(claims, "claims")
    positive = claims.where(F.col(weight) > 0)
    keys = [F.col(g).alias(f"_{g}") for g in group]
    sums = settle(positive.groupBy(*keys).agg(F.sum(F.col(weight).cast("double")).alias("_t"), F.count("*").alias("_n"), F.first(total).alias("_seats")), "claims-of-group")
    # a hair's breadth wider than the bounds, for rounded sums
    high = F.when(2 * F.col("_seats") > F.col("_n"), F.col("_t") / (2 * F.col("_seats") - F.col("_n")) * (1 + 1e-9)).otherwise(F.lit(float("inf")))
    low = F.when(F.col("_seats") > 0, F.col("_t") / (2 * F.col("_seats") + F.col("_n")) * (1 - 1e-9)).otherwise(F.lit(float("inf")))
    sums = sums.select(*[f"_{g}" for g in group], "_seats", high.alias("_high"), low.alias("_low"))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    at = positive.join(sums, same) if group else positive.crossJoin(F.broadcast(sums))  # without groups it is one row

    def above(bound: str) -> Column:
        """Quotients of a claim that reach the bound."""
        return F.floor((F.col(weight) / F.col(bound) + 1) / 2).cast("bigint")

    at = settle(at.withColumn("_sure", F.greatest(F.lit(0).cast("bigint"), above("_high"))).withColumn("_most", above("_low")), "claims-between")
    between = at.where("_most > _sure").withColumn("_k", F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))))
    between = between.withColumn("_q", F.col(weight) / (2 * F.col("_k") - 1))
    # what is left of a group's seats after the sure ones
    left = at.groupBy(*group).agg((F.first("_seats") - F.sum("_sure")).alias("_left"))
    left = settle(left.select(*[F.col(g).alias(f"_of_{g}") for g in group], "_left"), "seats-left")
    ranked = number_rows(between, [F.col("_q").desc(), *order, F.col("_k")], "_nth", group)
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    won = ranked.join(left, same) if group else ranked.crossJoin(F.broadcast(left))
    won = won.where(F.col("_nth") <= F.col("_left")).select(*claims.columns, F.lit(1).cast("bigint").alias(out))
    sure = at.select(*claims.columns, F.col("_sure").alias(out))
    none = claims.where(F.coalesce(F.col(weight) <= 0, F.lit(True))).select("*", F.lit(0).cast("bigint").alias(out))
    return sure.unionByName(won).unionByName(none).groupBy(*claims.columns).agg(F.sum(out).alias(out))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sources(source, source_size)`` with ``place`` (from 1, null last) and ``target``.

    Targets are proportional to the weights, which repeat in the order of the sources, and stop at ``most_epochs`` times
    the source's size; what a stopped source leaves goes to the others by weight, until none is above. That is
    min(cap, x * weight) with the x at which the targets add up, and x is the largest of (total - caps of the first i) /
    (weights of the others), sources ordered by cap / weight.
    """
    numbered = number_rows(sources.select("source", "source_size", F.col("source").isNull().alias("last")), [F.col("last"), F.col("source")], "place")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights)).cast("int")).cast("double")
    weighed = numbered.withColumn("weight", weight).withColumn("cap", (most_epochs * F.col("source_size")).cast("double"))
    weighed = settle(weighed.withColumn("stops", F.col("cap") / F.col("weight")), "weighed")
    held = running_totals(weighed, [F.col("stops"), F.col("place")], {"caps": F.col("cap"), "weighs": F.col("weight")}, (), "caps")
    totals = weighed.agg((F.sum("source_size") * share[0] / share[1]).alias("tokens"), F.sum("weight").alias("weights")).first()
    tokens, all_weights = float(totals["tokens"] or 0), float(totals["weights"] or 1)
    level = held.agg(F.max(F.when(F.col("weighs") < all_weights, (F.lit(tokens) - F.col("caps")) / (F.lit(all_weights) - F.col("weighs"))))).first()[0]
    level = max(tokens / all_weights, level or 0.0)
    return weighed.select("source", "source_size", "place", F.least(F.col("cap"), F.lit(level) * F.col("weight")).alias("target"))


def _numbered_copies(sized: DataFrame) -> DataFrame:
    """One row per row, equal rows told apart by ``copy``; however many are equal, no task lists them all."""
    counted = sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    rows = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES_AT_ONCE).cast("bigint")))
    runs = counted.withColumn("at", rows).withColumn("copy", F.col("at"))
    one = runs.where("n = 1").select("source", "doc_id", "size", "copy")
    many = runs.where("n > 1").repartition("source", "doc_id", "size", "at")
    every = F.sequence(F.col("at"), F.least(F.col("n"), F.col("at") + COPIES_AT_ONCE) - 1)
    return one.unionByName(many.select("source", "doc_id", "size", F.explode(every).alias("copy")))


def mix(
    docs: DataFrame,
    size: Column,
    seed: int = 42,
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = SHARE,
    most_epochs: int = MOST_EPOCHS,
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken.

    ``size`` is the token count of a row (null counts as 0); of the columns of ``docs`` only doc_id, source and those in
    ``size`` are read. ``target`` is that of the row's source, ``taken`` the tokens that the mix takes of the document,
    repeats counted, never more than ``most_epochs`` times its size. A null source is a source, the last one. Empty
    documents give 0; a table without tokens has targets 0. Rows that repeat a doc_id are taken each by itself; equal
    ones are interchangeable. An empty table gives an empty result. The result depends on the rows and the seed alone.
    """
    if min(weights) <= 0 or most_epochs * share[1] < share[0]:
        raise ValueError("weights are positive, and most_epochs at least the share")
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source"), F.coalesce(size.cast("bigint"), F.lit(0)).alias("size"))
    sized = settle(sized, "sizes")
    sources = settle(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    aimed = settle(targets(sources, weights, share, most_epochs), "targets")

    # a source's shards, and the documents in them; joined by place, as a source may be null
    keyed = settle(aimed.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"), "place", "source_size", "target"), "places")
    copies = _numbered_copies(sized).withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    placed = lookup_join(copies, keyed, "key", ["doc_id", "size", "copy"])
    token = F.concat_ws("|", F.lit(seed), "place", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "size", "copy")
    shards = F.floor(F.col("source_size") / F.lit(shard_tokens)).cast("bigint") + 1
    placed = placed.withColumn("shard", seeded(token) % shards).withColumn("at", F.md5(F.concat_ws("|", F.lit("order"), token)))
    placed = settle(placed.select("doc_id", "source", "size", "source_size", "target", "place", "shard", "at"), "placed")
    sums = placed.groupBy("place", "shard").agg(F.sum("size").alias("tokens"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    sums = settle(sums.withColumn("blocks", F.ceil(F.col("tokens") / block_tokens)).where("blocks > 0"), "shards")

    # blocks of the sources: as many as their targets are worth, counting the shorter blocks at the ends of shards
    of_source = sums.groupBy("place").agg(F.sum("blocks").alias("blocks"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    worth = settle(of_source.select("place", "blocks", (F.col("target") / F.col("source_size") * F.col("blocks")).alias("worth")), "worth")
    wanted = worth.agg(F.coalesce(F.round(F.sum(F.col("worth").cast("decimal(38,6)")), 0).cast("bigint"), F.lit(0))).first()[0]
    quotas = seats(worth.withColumn("wanted", F.lit(wanted).cast("bigint")), (), "worth", [F.col("place")], "wanted")
    quotas = quotas.select("place", F.least("quota", most_epochs * F.col("blocks")).alias("of_source"))
    claims = sums.select("place", "shard", "blocks", "tokens").join(quotas, "place")
    given = seats(claims, ("place",), "blocks", [F.col("shard")], "of_source").select("place", "shard", F.least("quota", most_epochs * F.col("blocks")).alias("quota"))

    def take(key: tuple, rows: pa.Table, quota: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        n = rows["size"].to_numpy()
        ends = np.cumsum(n)
        blocks = -(-int(ends[-1]) // block_tokens) if len(n) else 0
        times = np.zeros(blocks + 1, np.int64)
        if blocks and quota.num_rows:
            full, rest = divmod(quota["quota"][0].as_py(), blocks)
            times[:blocks] = full
            if rest:
                stem = f"{seed}|{key[0].as_py()}|{key[1].as_py()}|"
                order = sorted(range(blocks), key=lambda b: hashlib.md5(f"{stem}{b}".encode()).digest())
                times[order[:rest]] += 1
        before = np.concatenate([[0], np.cumsum(times[:blocks])]) * block_tokens  # tokens taken before each block

        def taken_until(x: np.ndarray) -> np.ndarray:
            return before[x // block_tokens] + times[x // block_tokens] * (x % block_tokens)

        taken = pa.array(taken_until(ends) - taken_until(ends - n), pa.int64())
        return rows.select(["doc_id", "source", "size", "source_size", "target"]).append_column("taken", taken)

    # a document without tokens has no place in a stream
    streams = placed.where("size > 0").groupBy("place", "shard").cogroup(given.groupBy("place", "shard"))
    taken = streams.applyInArrow(take, "doc_id bigint, source string, size bigint, source_size bigint, target double, taken bigint")
    return taken.unionByName(placed.where("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken")))
