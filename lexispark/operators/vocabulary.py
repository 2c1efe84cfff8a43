"""Vocabulary: document and corpus frequencies, pruning, sorted feature index, inverse document frequency."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.config import VectorConfig
from lexispark.functions.analyzer import analyze
from lexispark.functions.tokens import term_bag, token_counts
from lexispark.operators.scale import MAX_BROADCAST_ROWS, fits_broadcast, number_rows, settle


def postings(df: DataFrame, text: str, config: VectorConfig, keys=("doc_id",)) -> DataFrame:
    """``(keys, term, tf)``; a document's counts are made inside its own row, without a shuffle."""
    bag = df.select(*keys, F.explode(term_bag(analyze(F.col(text), config))).alias("posting"))
    return bag.select(*keys, "posting.term", F.col("posting.tf").cast("bigint").alias("tf"))


def term_stats(term_postings: DataFrame) -> DataFrame:
    """``(term, df, cf)``: documents that hold the term, and its occurrences."""
    return term_postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def counted_terms(df: DataFrame, tokens: Column) -> DataFrame:
    """The ``term_stats`` of an array of tokens that are not null. What leaves a task's first step are counts of many rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, _, term, count in token_counts(batch.column(0)):
                held = np.bincount(term, minlength=len(terms)), np.bincount(term, count, len(terms))
                yield pa.RecordBatch.from_arrays([terms, *(pa.array(x.astype(np.int64)) for x in held)], ["term", "df", "cf"])

    parts = df.select(tokens.alias("tokens")).mapInArrow(counted, "term string, df bigint, cf bigint")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def prune_min_df(stats: DataFrame, min_df: int) -> DataFrame:
    """Terms of at least ``min_df`` documents; a number of documents, not a share."""
    if min_df != int(min_df):
        raise ValueError(f"min_df counts documents and must be whole: {min_df}")
    return stats.where(F.col("df") >= min_df)


def prune_max_df(stats: DataFrame, max_df: float, n_docs: int) -> DataFrame:
    return stats.where(F.col("df") <= max_df * n_docs)


def limit_features(stats: DataFrame, max_features: int | None) -> DataFrame:
    """The ``max_features`` terms of highest corpus frequency, ties by term."""
    if max_features is None:
        return stats
    if max_features <= MAX_BROADCAST_ROWS // 10:
        return stats.orderBy(F.col("cf").desc(), "term").limit(max_features)
    if stats.count() <= max_features:
        return stats
    numbered = number_rows(stats, [F.col("cf").desc(), F.col("term")], "_number")
    return numbered.where(F.col("_number") <= max_features).drop("_number")


def index_terms(stats: DataFrame, bounded: bool) -> DataFrame:
    """Position of each term in sorted order, from 0. Only a table of bounded size is numbered in one task."""
    if bounded:
        return stats.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))
    numbered = number_rows(stats, [F.col("term")], "_number")
    return numbered.withColumn("idx", (F.col("_number") - 1).cast("int")).drop("_number")


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary: the settled table ``(term, idx, df, cf, idf)`` and the size of the fitted corpus."""

    table: DataFrame
    n_docs: int
    size: int
    small: bool
    config: VectorConfig

    def feature_names(self) -> DataFrame:
        return self.table.select("idx", "term")

    def idf(self) -> DataFrame:
        return self.table.select("term", "idf")

    def top_idf(self, n: int) -> DataFrame:
        return self.table.select("term", "idf").orderBy(F.col("idf").desc(), "term").limit(n)


def fit_vocabulary(df: DataFrame, text: str, config: VectorConfig) -> Vocabulary:
    """Count, prune, index and weight the terms of a corpus. Idf is smoothed: ln((1 + N) / (1 + df)) + 1."""
    n_docs = df.count()
    if config.max_df * n_docs < config.min_df:
        raise ValueError("max_df corresponds to fewer documents than min_df")
    stats = counted_terms(df, analyze(F.col(text), config))
    kept = settle(prune_max_df(prune_min_df(stats, config.min_df), config.max_df, n_docs), "term-stats")
    limited = limit_features(kept, config.max_features)
    bounded = config.max_features is not None and config.max_features <= MAX_BROADCAST_ROWS
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    indexed = index_terms(limited, bounded).withColumn("idf", idf)
    table = settle(indexed.select("term", "idx", "df", "cf", "idf"), "vocabulary")
    size = table.count()
    if size == 0:
        raise ValueError("No term is left in the vocabulary with these document frequency limits")
    return Vocabulary(table, n_docs, size, fits_broadcast(table), config)
