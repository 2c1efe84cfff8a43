"""Row preparation: dropping, labelling, combining, shuffling, sampling and exact stratified splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators.scale import first_rows, fits_broadcast, lookup_join, running_totals, settle

# The shuffle key is a hash, so its leading hex digits cut any table into even buckets.
_BUCKET_DIGITS = 4
BUCKET_ROWS = 100_000


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def identify(df: DataFrame, column: str = "doc_id") -> DataFrame:
    """Give the rows of a table without a key unique ids. The result is written, so that they stay the same."""
    return settle(df.withColumn(column, F.monotonically_increasing_id()), "identified")


def label_threshold(df: DataFrame, column: str, threshold: float, label: str = "label") -> DataFrame:
    """1 where the value reaches the threshold, else 0; a missing value is 0."""
    return df.withColumn(label, F.coalesce(F.col(column) >= threshold, F.lit(False)).cast("int"))


def label_equals(df: DataFrame, column: str, value, label: str = "label") -> DataFrame:
    return df.withColumn(label, F.col(column).eqNullSafe(value).cast("int"))


def fill_text(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit("")))


def drop_missing_text(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def head_per_source(df: DataFrame, n: int, order: str = "doc_id", source: str = "source") -> DataFrame:
    """The first ``n`` rows of every source in the order of ``order``, which must be unique within a source."""
    return first_rows(df, [F.col(order)], n, "_position", [source]).drop("_position")


def combine(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Concatenate datasets under a ``source`` column; ``(source, id)`` stays the key."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in frames.items()]
    result = tagged[0]
    for df in tagged[1:]:
        result = result.unionByName(df)
    return result


def shuffle_key(seed: int, keys: Sequence[str]) -> Column:
    """A reproducible pseudo-random sort key that depends on the seed and the row's identity only."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(key).cast("string") for key in keys]))


def shuffle(df: DataFrame, seed: int, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Seeded global shuffle: ``position`` numbers the rows from 0 in shuffled order.

    A bucketed scatter: the rows of each prefix of the hash are counted, which gives every bucket its first position; then
    each row crosses one exchange to its bucket, where it is numbered. Buckets have about ``BUCKET_ROWS`` rows. ``keys``
    identify a row.
    """
    rows = df.count()
    digits = 1
    while rows / 16**digits > BUCKET_ROWS:
        digits += 1
    bucket = F.substring(shuffle_key(seed, keys), 1, digits)
    counts = settle(df.select(bucket.alias("_bucket")).groupBy("_bucket").agg(F.count("*").alias("_n")), "bucket-counts")
    ends = running_totals(counts, [F.col("_bucket")], {"_end": F.col("_n")}, name="bucket-ends")
    starts = settle(ends.select("_bucket", (F.col("_end") - F.col("_n")).alias("_start")), "bucket-starts")
    keyed = df.withColumn("_key", shuffle_key(seed, keys)).withColumn("_bucket", bucket)
    # beyond the broadcast bounds both sides meet by bucket, which is the exchange that the numbering needs anyway
    placed = keyed.join(F.broadcast(starts) if fits_broadcast(starts) else starts, "_bucket")
    inside = Window.partitionBy("_bucket").orderBy("_key", *[F.col(key) for key in keys])
    position = F.col("_start") + F.row_number().over(inside) - 1
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], position.alias("position"))


def _group_key(group: str) -> Column:
    """A key that is never null, with null as a group of its own."""
    return F.to_json(F.struct(F.col(group).alias("g")))


def _narrow(df: DataFrame, group: str, keys: Sequence[str]) -> DataFrame:
    """Keys and group, written once: all counting and sorting of a split reads this table and not its input."""
    return settle(df.select(group, *[key for key in keys if key != group]), "split-keys")


def _first_by_hash(df: DataFrame, narrow: DataFrame, quotas: DataFrame, group: str, keys: Sequence[str], seed: int) -> DataFrame:
    """Mark (``_chosen``) the ``quota`` rows with the smallest shuffle keys of every group.

    Instead of sorting the table, the bucket that holds each group's last chosen row is found from counts, only that
    bucket is sorted, and its cut key is compared with every row. The large table is never shuffled.
    """
    def with_keys(rows: DataFrame) -> DataFrame:
        names = F.concat_ws("|", *[F.col(key).cast("string") for key in keys])
        return rows.withColumn("_key", shuffle_key(seed, keys)).withColumn("_id", names).withColumn("_group", _group_key(group))

    keyed = with_keys(narrow)
    quotas = quotas.select(_group_key(group).alias("_group"), "quota")
    bucket = F.substring("_key", 1, _BUCKET_DIGITS)
    counts = keyed.groupBy("_group", bucket.alias("_bucket")).count()
    up_to_here = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    # one row per group: the bucket in which the quota is used up, and how many of its rows are still needed
    last = settle(
        counts.withColumn("_seen", F.sum("count").over(up_to_here))
        .join(quotas, "_group")
        .where((F.col("_seen") >= F.col("quota")) & (F.col("_seen") - F.col("count") < F.col("quota")))
        .select("_group", "_bucket", (F.col("quota") - F.col("_seen") + F.col("count")).alias("_need")),
        "last-bucket",
    )
    inside = Window.partitionBy("_group", "_bucket").orderBy("_key", "_id")
    cut = settle(
        keyed.withColumn("_bucket", bucket)
        .join(F.broadcast(last) if fits_broadcast(last) else last, ["_group", "_bucket"])
        .withColumn("_place", F.row_number().over(inside))
        .where(F.col("_place") == F.col("_need"))
        .select("_group", F.struct("_key", "_id").alias("_cut")),
        "cut",
    )
    chosen = F.coalesce(F.struct("_key", "_id") <= F.col("_cut"), F.lit(False))
    marked = lookup_join(with_keys(df), cut, "_group", keys, "left").withColumn("_chosen", chosen)
    return marked.drop("_key", "_id", "_cut", "_group")


def sample_n(df: DataFrame, n: int, seed: int, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The first ``n`` rows of the seeded shuffle (all rows if there are fewer)."""
    grouped = df.withColumn("_all", F.lit(0))
    narrow = _narrow(grouped, "_all", keys)
    rows = narrow.groupBy("_all").agg(F.least(F.count("*"), F.lit(n)).alias("quota"))
    return _first_by_hash(grouped, narrow, rows, "_all", keys, seed).where("_chosen").select(*df.columns)


def holdout_quotas(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """Test rows per class: ``ceil(test_size * n)`` in all, class shares kept, remainders largest first."""
    if not 0 < test_size < 1:
        raise ValueError(f"test_size must lie between 0 and 1: {test_size}")
    everything = Window.partitionBy(F.lit(0))
    counts = df.groupBy(label).count().withColumn("_n", F.sum("count").over(everything))
    shares = counts.withColumn("_test", F.ceil(F.lit(test_size) * F.col("_n"))).withColumn(
        "_floor", F.expr("(_test * count) div _n")
    )
    by_remainder = everything.orderBy(F.expr("(_test * count) % _n").desc(), F.col(label))
    missing = F.col("_test") - F.sum("_floor").over(everything)
    return shares.select(
        label, (F.col("_floor") + (F.row_number().over(by_remainder) <= missing).cast("bigint")).alias("quota")
    )


def stratified_split(
    df: DataFrame, label: str = "label", test_size: float = 0.2, seed: int = 42, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Add ``split`` (``train``/``test``) with exact sizes and class quotas, in the order of the seeded shuffle."""
    narrow = _narrow(df, label, keys)
    quotas = holdout_quotas(narrow, label, test_size)
    marked = _first_by_hash(df, narrow, quotas, label, keys, seed)
    return marked.withColumn("split", F.when(F.col("_chosen"), "test").otherwise("train")).select(*df.columns, "split")


def split_report(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per split and class, the split's size and its share of all rows."""
    per_class = df.groupBy("split", label).count()
    split, everything = Window.partitionBy("split"), Window.partitionBy(F.lit(0))
    size = F.sum("count").over(split)
    return per_class.select(
        "split",
        label,
        F.col("count").alias("n"),
        size.alias("split_size"),
        (size / F.sum("count").over(everything)).alias("split_share"),
        (F.col("count") / size).alias("class_share"),
    )
