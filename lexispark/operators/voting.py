"""Combining the predictions of several models. Input is the long form ``(keys, model, prediction, score)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def majority_vote(predictions: DataFrame, keys: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """The most frequent prediction per key; a tie goes to the smallest label."""
    return predictions.groupBy(*keys).agg(F.mode("prediction", deterministic=True).alias("prediction"))


def average_score(predictions: DataFrame, keys: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """1 where the mean score is strictly above one half. Missing scores are skipped; a key without any is an error."""
    averaged = predictions.groupBy(*keys).agg(F.avg("score").alias("score"))
    checked = F.when(F.col("score").isNull(), F.raise_error(F.lit("a row without any score has no average")))
    return averaged.withColumn("prediction", checked.otherwise((F.col("score") > 0.5).cast("int")))


def ensemble(predictions: DataFrame, method: str = "majority_vote", keys: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    if method == "majority_vote":
        return majority_vote(predictions, keys)
    if method == "average_proba":
        return average_score(predictions, keys)
    raise ValueError(f"no such way to combine predictions: {method}")
