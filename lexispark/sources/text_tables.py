"""Reading and writing the text datasets, each with a fixed schema (no inference pass over the files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.sources.csv_records import records

# Spark's CSV writer trims values by default
VERBATIM = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}

PROCESSED_SCHEMA = "processed string, label int"
TWEET_SCHEMA = "polarity int, id bigint, date string, query string, user string, text string"


def read_reviews(spark: SparkSession, path: str, header: list[str] | None = None, multi_line: bool = True) -> DataFrame:
    """Headed review CSV, reduced to ``Text`` and ``Score``. Quoted fields may span lines unless ``multi_line`` is switched
    off; large files are read by many tasks either way, see ``csv_records``.

    The schema covers the file's columns by position, so the header names come from ``header`` or one line of a file.
    """
    options = {"header": True, "escape": '"'}
    names = header or spark.read.options(**options).option("inferSchema", False).csv(path).columns
    schema = ", ".join(f"`{name}` {'int' if name == 'Score' else 'string'}" for name in names)
    if not multi_line:
        return spark.read.options(**options).schema(schema).csv(path).select("Text", "Score")
    parsed = records(spark, path).select(F.from_csv("value", schema, {"escape": '"', "mode": "PERMISSIVE"}).alias("r"))
    return parsed.select("r.Text", "r.Score")


def read_tweets(spark: SparkSession, path: str) -> DataFrame:
    """Headerless latin-1 CSV with the six tweet columns."""
    options = {"header": False, "encoding": "ISO-8859-1", "escape": '"'}
    return spark.read.options(**options).schema(TWEET_SCHEMA).csv(path)


def read_processed(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Processed texts with labels; an empty text comes back as null. Without line breaks the files stay splittable."""
    if format == "parquet":
        df = spark.read.parquet(path)
        return df.withColumn("processed", F.nullif("processed", F.lit("")))
    return spark.read.schema(PROCESSED_SCHEMA).csv(path, header=True, nullValue="", escape='"')


def write_processed(df: DataFrame, path: str, format: str = "csv") -> None:
    """CSV holds ``processed`` and ``label``; Parquet keeps ``doc_id`` and is partitioned by ``source``, where there are such."""
    if format == "parquet":
        columns = [c for c in ("doc_id", "processed", "label", "source") if c in df.columns]
        writer = df.select(*columns).write.mode("overwrite")
        (writer.partitionBy("source") if "source" in columns else writer).parquet(path)
        return
    df.select("processed", "label").write.mode("overwrite").csv(path, header=True, emptyValue="", **VERBATIM)


def write_results(df: DataFrame, path: str) -> None:
    """The model comparison table, one row per model, as one headed CSV file."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True, **VERBATIM)
