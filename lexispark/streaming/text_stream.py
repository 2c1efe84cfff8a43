"""The text processing on a stream. Cleaning and tokenizing are stateless column expressions, so a stream of raw
texts is processed with the plan of a batch. Lemmas and stems are made for a whole corpus's vocabulary and are not offered
on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.config import CleanConfig
from lexispark.functions.tokens import filtered_tokens, join_tokens


def process_stream(df: DataFrame, text: str, config: CleanConfig, out: str = "processed") -> DataFrame:
    """Add the processed text. Set-wide normalization is not available on an unbounded input."""
    if config.lemmatization or config.stemming:
        raise ValueError("Lemmas and stems come from the whole vocabulary; switch them off for a stream")
    return df.withColumn(out, join_tokens(filtered_tokens(F.col(text), config)))
