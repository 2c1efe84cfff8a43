"""Evaluation of binary or multi-class predictions ``(model, label, prediction[, score])``.

Everything but the AUC derives from the confusion counts, so the predictions are read and reduced once for all
models; what is shuffled has one row per model and cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.operators.scale import running_totals
from lexispark.operators.voting import majority_vote

METRICS = ("accuracy", "precision", "recall", "f1", "auc_score")


def confusion(predictions: DataFrame) -> DataFrame:
    """``(model, label, prediction, n)`` completed over all labels that occur on either side."""
    counts = predictions.groupBy("model", "label", "prediction").agg(F.count("*").alias("n"))
    # one row per model with the short list of its classes
    classes = counts.groupBy("model").agg(
        F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("_classes")
    )
    grid = classes.select("model", "_classes", F.explode("_classes").alias("label")).select(
        "model", "label", F.explode("_classes").alias("prediction")
    )
    return grid.join(counts, ["model", "label", "prediction"], "left").na.fill(0, ["n"])


def confusion_normalized(predictions: DataFrame) -> DataFrame:
    """The confusion counts as shares of their true label."""
    of_label = F.sum("n").over(Window.partitionBy("model", "label"))
    return confusion(predictions).withColumn("share", F.try_divide(F.col("n"), of_label))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_scores(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per model and class; 0 where a ratio is undefined."""
    counts = predictions.groupBy("model", "label", "prediction").agg(F.count("*").alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")

    def side(name: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(name).alias("class"), support.alias("support"), predicted.alias("predicted"), hits.alias("hits")
        )

    as_true = side("label", F.col("n"), none, hit.cast("bigint"))
    as_predicted = side("prediction", none, F.col("n"), none)
    sides = counts.select("model", F.explode(F.array(as_true, as_predicted)).alias("side")).select("model", "side.*")
    totals = sides.groupBy("model", "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    precision, recall = _ratio(F.col("hits"), F.col("predicted")), _ratio(F.col("hits"), F.col("support"))
    return totals.select(
        "model",
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
        "hits",
    )


def _weighted(column: str) -> Column:
    return F.sum(F.col(column) * F.col("support")) / F.sum("support")


def _overall() -> list[Column]:
    return [
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
        _weighted("f1").alias("f1"),
    ]


def label_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy and the support-weighted precision, recall and F1 per model."""
    return class_scores(predictions).groupBy("model").agg(*_overall())


def accuracy(predictions: DataFrame) -> DataFrame:
    hits = F.count_if(F.col("label") == F.col("prediction"))
    return predictions.groupBy("model").agg((hits / F.count("*")).alias("accuracy"))


def weighted_precision(predictions: DataFrame) -> DataFrame:
    return label_metrics(predictions).select("model", "precision")


def weighted_recall(predictions: DataFrame) -> DataFrame:
    return label_metrics(predictions).select("model", "recall")


def weighted_f1(predictions: DataFrame) -> DataFrame:
    return label_metrics(predictions).select("model", "f1")


def auc(predictions: DataFrame) -> DataFrame:
    """Area under the ROC curve of the class-1 score per model, ties counted half; null if only one class occurs.

    Rows are reduced to one per distinct score. Of each positive, the negatives below it are needed: a running total
    over all scores, taken block by block of the score range.
    """
    scored = predictions.where(F.col("score").isNotNull())
    per_score = scored.groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("_positives"), F.count_if(F.col("label") != 1).alias("_negatives")
    )
    ordered = running_totals(per_score, [F.col("score")], {"_up_to": F.col("_negatives")}, ["model"], "roc")
    # twice the number of (positive, negative) pairs in the right order, so that it stays a whole number
    won = F.sum(F.col("_positives").cast("decimal(38,0)") * (2 * F.col("_up_to") - F.col("_negatives")))
    pairs = F.sum("_positives").cast("double") * F.sum("_negatives").cast("double")
    area = ordered.groupBy("model").agg((won.cast("double") / F.nullif(2 * pairs, F.lit(0.0))).alias("auc_score"))
    return predictions.select("model").distinct().join(area, "model", "left")


def evaluate_all(predictions: DataFrame) -> DataFrame:
    """One metrics row per model, all models in one job."""
    return label_metrics(predictions).join(auc(predictions), "model").select("model", *METRICS)


def evaluate(predictions: DataFrame) -> DataFrame:
    """The metrics row of a single model's predictions."""
    return evaluate_all(predictions)


def classification_report(predictions: DataFrame) -> DataFrame:
    """Per-class rows, then accuracy, macro and weighted averages, at two decimals; ``line`` keeps their order."""
    classes = class_scores(predictions)
    per_class = classes.select(
        "model",
        F.row_number().over(Window.partitionBy("model").orderBy("class")).alias("line"),
        F.col("class").cast("string").alias("name"),
        "precision",
        "recall",
        "f1",
        "support",
    )
    totals = classes.groupBy("model").agg(
        F.count("*").alias("_n"),
        F.sum("support").alias("_support"),
        (F.sum("hits") / F.sum("support")).alias("_accuracy"),
        *[F.avg(m).alias(f"_macro_{m}") for m in ("precision", "recall", "f1")],
        *[_weighted(m).alias(f"_weighted_{m}") for m in ("precision", "recall", "f1")],
    )

    def row(place: int, name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            (F.col("_n") + place).cast("int").alias("line"),
            F.lit(name).alias("name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("_support").alias("support"),
        )

    nothing = F.lit(None).cast("double")
    averages = totals.select(
        "model",
        F.explode(
            F.array(
                row(1, "accuracy", nothing, nothing, F.col("_accuracy")),
                *[
                    row(place, f"{kind} avg", *[F.col(f"_{kind}_{m}") for m in ("precision", "recall", "f1")])
                    for place, kind in ((2, "macro"), (3, "weighted"))
                ],
            )
        ).alias("r"),
    ).select("model", "r.*")
    report = per_class.unionByName(averages)
    for metric in ("precision", "recall", "f1"):
        report = report.withColumn(metric, F.round(metric, 2))
    return report


def best_model(metrics: DataFrame, metric: str = "f1", position: str = "position") -> DataFrame:
    """The model with the highest metric; the first added wins a tie, a missing metric never wins."""
    if metric not in METRICS:
        raise ValueError(f"Unknown metric: {metric}")
    return metrics.where(F.col(metric).isNotNull()).orderBy(F.col(metric).desc(), position).limit(1)


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """``(model, metric, value)`` without missing values."""
    long = metrics.unpivot("model", list(METRICS), "metric", "value")
    return long.where(F.col("value").isNotNull())


def evaluate_vote(predictions: DataFrame, keys=("doc_id", "label"), name: str = "ensemble") -> DataFrame:
    """Metrics of the majority vote over all models; a vote has no score and so no AUC."""
    voted = majority_vote(predictions, keys).withColumn("model", F.lit(name))
    return label_metrics(voted).withColumn("auc_score", F.lit(None).cast("double")).select("model", *METRICS)


def comparison_table(predictions: DataFrame, keys=("doc_id", "label")) -> DataFrame:
    """The metrics of every model with the vote's row appended."""
    return evaluate_all(predictions).unionByName(evaluate_vote(predictions, keys))
