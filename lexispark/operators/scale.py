"""Building blocks that keep the operators safe at scale: written intermediate tables, size-checked broadcasts,
salted joins, and running totals over a global order without a single-task window."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A lookup side is broadcast only up to both bounds; beyond them it is shuffled with salted keys.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
# A scan's largest split may hold so many times the rows of the average one
UNEVEN = 2
# row_number() <= k is pruned inside each task by Spark up to this k (its window group limit threshold)
TASK_LOCAL_TOP_K = 1000


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's checkpoint folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="lexispark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame, name: str, schema: T.StructType | None = None, **options: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back, on request as another schema of the same storage.

    ``options`` are those of the writer.

    Cuts the lineage so that a lost executor re-reads instead of recomputing, computes the table once however often
    it is used, and gives Spark its real size, from which it picks the join strategy.
    """
    path = f"{work_dir(df.sparkSession)}/lexispark/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal the rows of a file scan to all cores if it has fewer splits than cores, or a split far larger than the others.

    Text work costs far more than reading. A row group is one task however many splits its file has, so a file of few
    large row groups keeps most splits empty; how many rows a split has is counted without reading a column.
    """
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if splits < cores:
        return df.repartition(cores, *by)
    held = df.groupBy(F.spark_partition_id().alias("split")).count()
    largest, rows = held.agg(F.coalesce(F.max("count"), F.lit(0)), F.coalesce(F.sum("count"), F.lit(0))).first()
    return df.repartition(splits, *by) if largest * splits > UNEVEN * rows else df


def _measured(settled: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a settled table (one cheap scan)."""
    sizes = [F.octet_length(F.col(f.name)) for f in settled.schema if isinstance(f.dataType, T.StringType)]
    text_bytes = sum((F.coalesce(size, F.lit(0)) for size in sizes), F.lit(0))
    return tuple(settled.agg(F.count("*"), F.coalesce(F.sum(text_bytes + 16 * len(settled.columns)), F.lit(0))).first())


def fits_broadcast(settled: DataFrame) -> bool:
    """Measure a settled table against the broadcast bounds."""
    rows, size = _measured(settled)
    return rows <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES


def broadcast_parts(settled: DataFrame, most: int) -> int:
    """How many broadcasts within the bounds a settled table makes, or 0 if more than ``most``."""
    rows, size = _measured(settled)
    if MAX_BROADCAST_ROWS <= 0 or MAX_BROADCAST_BYTES <= 0:
        return 0
    parts = max(1, -(-rows // MAX_BROADCAST_ROWS), -(-size // MAX_BROADCAST_BYTES))
    return parts if parts <= most else 0


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, spread: Sequence[str], how: str = "inner", broadcast: bool | None = None
) -> DataFrame:
    """Join a large table to a settled lookup table.

    A lookup of checked size is broadcast: no shuffle and no skew. A larger one is repeated once per salt, and the
    facts choose their salt from the ``spread`` columns, so that a key holding a large share of all rows is dealt to
    many tasks.
    """
    if fits_broadcast(lookup) if broadcast is None else broadcast:
        return facts.join(F.broadcast(lookup), key, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    repeated = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")


def running_totals(
    df: DataFrame, order: Sequence[Column], totals: dict[str, Column], group: Sequence[str] = (), name: str = "ordered"
) -> DataFrame:
    """Add, per group, the exact total of each measure over all rows up to and including the current one.

    The rows are range-partitioned by group and order and written with their block number. Each block is summed on
    its own; the totals of earlier blocks come from a table with one row per block and group. No task sees more than
    a block, however large a group is. The order must be unique within a group.
    """
    group = list(group)
    blocks = settle(
        df.repartitionByRange(*[F.col(g) for g in group], *order).withColumn("_block", F.spark_partition_id()), name
    )
    inside = Window.partitionBy(*group, "_block")
    summed = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = blocks.select("*", *[F.sum(m).over(summed).alias(out) for out, m in totals.items()])

    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        blocks.groupBy(*group, "_block")
        .agg(*[F.sum(m).alias(f"_{out}") for out, m in totals.items()])
        .select(
            *[F.col(g).alias(f"_of_{g}") for g in group],
            F.col("_block").alias("_of_block"),
            *[F.coalesce(F.sum(f"_{out}").over(earlier), F.lit(0)).alias(f"_{out}") for out in totals],
        ),
        f"{name}-starts",
    )
    same = F.col("_block") == F.col("_of_block")
    for g in group:  # null is a group like any other
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    joined = local.join(F.broadcast(starts) if fits_broadcast(starts) else starts, same)
    return joined.select(
        *df.columns, *[(F.col(out) + F.col(f"_{out}")).alias(out) for out in totals]
    )


def number_rows(df: DataFrame, order: Sequence[Column], column: str, group: Sequence[str] = ()) -> DataFrame:
    """Number all rows from 1 in a unique global order (per group if given), without a single-task window."""
    return running_totals(df, order, {column: F.lit(1).cast("bigint")}, group, "numbered")


def first_rows(df: DataFrame, order: Sequence[Column], n: int, column: str, group: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows (per group) with their number. Small ``n`` is pruned inside each task before the shuffle."""
    if n > TASK_LOCAL_TOP_K:
        return number_rows(df, order, column, group).where(F.col(column) <= n)
    best_first = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(best_first)).where(F.col("_rank") <= n)
    return ranked.withColumn(column, F.col("_rank").cast("bigint")).drop("_rank")
