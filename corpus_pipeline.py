"""The training-data pipeline: stages that each read what the one before kept, written as Parquet in between.

All stages but the last return the columns of ``documents``; the last one returns the packed pieces of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm import decontaminate, jaccard, language, packing, secrets
from lexispark.operators.scale import settle


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language: texts go that are null, have no letters or are too far from every profile.

    How far is calibrated on the labelled documents. If no language could be learned, all texts with letters stay.
    """
    profiles = language.learn(docs)
    least = language.limits(docs, profiles) if profiles.names else {}
    return docs.where(language.recognised(F.col("text"), profiles, least))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by five-word shingles with a similarity of 0.8 or more: that of smallest doc_id.

    Every row is a document of its own: of rows that repeat a text one stays, whether they share a doc_id, have none or
    different ones, and rows that share a doc_id but not their text do not touch each other. Among equal ids the first row
    stays, rows without an id come last. Rows without words stay. Rows are told apart by their place in the table that
    was read, so ``docs`` is a table and not the result of a shuffle.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    texts = numbered.select(F.col(row).alias("doc_id"), "text")
    classes = jaccard.shingle_classes(texts, k=5, percent=80).select(F.col("doc_id").alias(row), "component_id")
    ids = numbered.select(row, F.col("doc_id").isNull().alias("last"), "doc_id")
    first = F.min(F.struct("last", "doc_id", row))  # taken map-side first, however large a group is
    kept = classes.join(ids, row).groupBy("component_id").agg(first.alias("first")).select(F.col("first")[row].alias(row))
    return numbered.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, up to a few edits."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in the text and ``n_chars`` brought up to date."""
    columns = [F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return secrets.masked(docs).select(*columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in bins of the permitted lengths; a token is a word."""
    return packing.pack(docs, packing.word_count(F.col("text")))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# learned profiles, components and packing are iterative: tests hold the stages against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
