"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.operators.scale import settle

MOST_ROUNDS = 60


def _settled(edges: DataFrame) -> bool:
    """Whether distinct links ``a < b`` are stars: no node has two smaller neighbours, or a smaller and a larger one."""
    smaller = edges.select(F.col("b").alias("node"), F.lit(1).alias("smaller"), F.lit(0).alias("larger"))
    larger = edges.select(F.col("a").alias("node"), F.lit(0).alias("smaller"), F.lit(1).alias("larger"))
    ends = smaller.unionByName(larger).groupBy("node").agg(F.sum("smaller").alias("smaller"), F.max("larger").alias("larger"))
    return ends.where("smaller > 1 OR smaller = 1 AND larger = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(node, component)``: for every linked node the smallest node that it can reach.

    Each step replaces links by links to the smallest neighbour, so that the table never grows beyond the given links;
    the minima are taken map-side first, and joins on a node with many links are ones that Spark can split. Nulls and
    loops are ignored; without links the result is empty.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = settle(edges, "links")
    for _ in range(MOST_ROUNDS):
        if _settled(edges):
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
                edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
            )
        # large star: the larger neighbours of a node move to the smallest node around it
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").where("b > a").select(F.col("least").alias("a"), "b")  # a row for each link, repeated or not
        # small star: the smaller neighbours of a node, and the node itself, move to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("least"))
        moved = large.join(least, "b").where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
        edges = settle(moved.unionByName(least.select(F.col("least").alias("a"), "b")).distinct(), "stars")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
