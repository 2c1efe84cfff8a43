"""Corpus profile: sizes, token counts, histograms, top tokens and label shares. All reduce before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions.tokens import tokenize_whitespace
from lexispark.operators.scale import first_rows


def dataset_summary(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count("*").alias("n_rows")).withColumn("columns", F.lit(",".join(df.columns)))


def token_counts(df: DataFrame, text: str = "processed", out: str = "n_tokens") -> DataFrame:
    return df.withColumn(out, F.size(tokenize_whitespace(F.coalesce(F.col(text), F.lit("")))))


def length_histogram(counts: DataFrame, bins: int, value: str = "n_tokens", source: str = "source") -> DataFrame:
    """Equal-width histogram per source between its own minimum and maximum; the last bin is closed.

    The table is first reduced to one row per distinct length, so bounds and bins come from one scan.
    """
    lengths = counts.groupBy(source, value).count()
    per_source = Window.partitionBy(source)
    low, high = F.min(value).over(per_source), F.max(value).over(per_source)
    # a source with a single length gets a range of width one around it
    bounded = lengths.withColumn("_low", F.when(low == high, low - 0.5).otherwise(low)).withColumn(
        "_width", F.when(low == high, F.lit(1.0)).otherwise(high - low) / bins
    )
    place = F.floor((F.col(value) - F.col("_low")) / F.col("_width"))
    return (
        bounded.groupBy(source, "_low", "_width", F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("count").alias("n"))
        .select(
            source,
            "bin",
            (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
            (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"),
            "n",
        )
    )


def length_stats(counts: DataFrame, value: str = "n_tokens", source: str = "source") -> DataFrame:
    """Mean and exact median. The percentile aggregate keeps a count per distinct length, not the rows."""
    return counts.groupBy(source).agg(
        F.avg(value).alias("mean_tokens"), F.percentile(value, F.lit(0.5)).alias("median_tokens")
    )


def length_quantiles(
    counts: DataFrame, shares: Sequence[float], accuracy: int = 10_000, value: str = "n_tokens", source: str = "source"
) -> DataFrame:
    """``(source, share, quantile)`` from mergeable sketches, for values with about as many distinct ones as rows.

    The rank of a quantile is off by 1 / ``accuracy`` of the source's rows at most. A sketch has a bounded number of entries
    however many values there are, where ``length_stats`` keeps one for each distinct value.
    """
    if not shares or not all(0 <= share <= 1 for share in shares):
        raise ValueError(f"shares lie between 0 and 1: {shares}")
    wanted = F.array(*[F.lit(float(share)) for share in shares])
    found = counts.groupBy(source).agg(F.approx_percentile(value, list(map(float, shares)), accuracy).alias("_found"))
    return found.select(source, F.explode(F.arrays_zip(wanted.alias("share"), F.col("_found").alias("quantile"))).alias("q")).select(source, "q.share", "q.quantile")


def token_frequencies(df: DataFrame, by: Sequence[str], text: str = "processed") -> DataFrame:
    # a missing text has no tokens; filtering it first would repeat a computed text in the filter
    tokens = df.select(*by, F.explode(tokenize_whitespace(F.col(text))).alias("term"))
    return tokens.groupBy(*by, "term").count()


def top_tokens(df: DataFrame, n: int, text: str = "processed", source: str = "source") -> DataFrame:
    """The ``n`` most frequent tokens per source, missing texts skipped, ties by term."""
    counts = token_frequencies(df, [source], text)
    return first_rows(counts, [F.col("count").desc(), F.col("term")], n, "rank", [source])


def label_counts(df: DataFrame, label: str = "label", source: str = "source") -> DataFrame:
    return df.groupBy(source, label).agg(F.count("*").alias("n"))


def label_shares(df: DataFrame, label: str = "label") -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))
