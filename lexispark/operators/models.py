"""Classifiers fitted with Spark ML, and their predictions in long form ``(keys, label, model, prediction, score)``."""

from __future__ import annotations

import logging
import math
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import (
    LinearSVCModel,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lexispark.operators.forest import fit_sparse_forest
from lexispark.operators.newton import fit_squared_hinge
from lexispark.operators.scale import lookup_join, settle

logger = logging.getLogger(__name__)

# Spark ML's forest holds four bytes for each row and feature; up to so many bytes in all it is used
DENSE_BYTES = 1 << 29
# Spark ML's limit; stands for an unlimited depth
MAX_DEPTH = 30


# An iteration of a linear solver is one job over the rows; below this many rows per task, scheduling outweighs work.
_ROWS_PER_LINEAR_TASK = 20_000


def _for_linear_solver(train: DataFrame) -> tuple[DataFrame, int]:
    rows = train.count()
    tasks = max(1, math.ceil(rows / _ROWS_PER_LINEAR_TASK))
    return train.coalesce(tasks), rows


def fit_logistic(
    train: DataFrame,
    C: float = 1.0,
    max_iter: int = 1000,
    label: str = "label",
    features: str = "features",
    random_state: int | None = None,
) -> Model:
    """L2 logistic regression; the solver draws nothing, so ``random_state`` has no effect. With the penalty 1 / (C * n) the objective is that of the C formulation over n rows."""
    rows, n = _for_linear_solver(train)
    return LogisticRegression(
        labelCol=label,
        featuresCol=features,
        regParam=1.0 / (C * n),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-4,
    ).fit(rows)


def fit_svm(
    train: DataFrame,
    C: float = 1.0,
    max_iter: int = 1000,
    label: str = "label",
    features: str = "features",
    random_state: int | None = None,
) -> Model:
    """Linear support vector machine with squared hinge loss and an intercept that is penalised like the weights.

    A trust-region Newton method, see ``newton``; it draws nothing, so ``random_state`` has no effect.
    """
    rows, n = _for_linear_solver(train.select(label, features))
    first = rows.select(F.max(F.coalesce(F.unwrap_udt(features)["size"], F.size(F.unwrap_udt(features)["values"])))).first()
    if first[0] is None:
        raise ValueError("Cannot fit a model without rows")
    weights = fit_squared_hinge(rows, first[0], n, C, max_iter, label, features)
    jvm = train.sparkSession.sparkContext._jvm
    # Spark has no public way to make a model of given weights
    made = jvm.org.apache.spark.ml.classification.LinearSVCModel(
        f"LinearSVC_{uuid.uuid4().hex[:12]}", _py2java(train.sparkSession.sparkContext, Vectors.dense(weights[:-1])), float(weights[-1])
    )
    return LinearSVCModel(made).setFeaturesCol(features)


def fit_forest(
    train: DataFrame,
    n_estimators: int = 100,
    max_depth: int | None = None,
    min_samples_split: int = 2,
    seed: int = 42,
    label: str = "label",
    features: str = "features",
    random_state: int | None = None,
) -> Model:
    """Random forest. ``max_depth`` None means 30, the deepest that is possible; more is an error.

    Spark ML makes a dense array of every row and holds its counts of many nodes in each task. Rows that would be more than
    ``DENSE_BYTES`` as such arrays stay sparse, see ``forest``.
    """
    if max_depth is not None and max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth is at most {MAX_DEPTH}: {max_depth}")
    estimator = RandomForestClassifier(
        labelCol=label,
        featuresCol=features,
        numTrees=n_estimators,
        maxDepth=MAX_DEPTH if max_depth is None else max_depth,
        minInstancesPerNode=math.ceil(min_samples_split / 2),
        featureSubsetStrategy="sqrt",
        maxMemoryInMB=1024,
        seed=seed if random_state is None else random_state,
    )
    vector = F.unwrap_udt(features)
    rows, size = train.agg(F.count("*"), F.max(F.coalesce(vector["size"], F.size(vector["values"])))).first()
    if rows * (size or 0) * 4 <= DENSE_BYTES:
        return estimator.fit(train)
    return fit_sparse_forest(train, estimator, rows, size)


_FITTERS = {"logistic_regression": fit_logistic, "svm": fit_svm, "random_forest": fit_forest}


@dataclass(frozen=True)
class FittedModel:
    """A named fitted model; ``position`` is the order in which it was added."""

    name: str
    model: Model
    position: int


def fit_all(
    classifiers: Mapping[str, Mapping[str, Any]],
    train: DataFrame,
    seed: int = 42,
    features: str = "features",
    fit_one: Callable[[str, Callable[[], Model]], Model] = lambda name, fit: fit(),
) -> list[FittedModel]:
    """Fit all models on one cached feature table.

    Each fit is a chain of distributed jobs; the chains run side by side, so that the short jobs of one solver do not
    leave the cluster idle. An unknown name is skipped with a warning. ``fit_one`` gets the name and the fit of each model and
    may know the model from an earlier run.
    """
    known = {}
    for name, params in classifiers.items():
        if name in _FITTERS:
            known[name] = {"seed": seed, **params} if name == "random_forest" else dict(params)
        else:
            logger.warning("Unknown classifier: %s", name)
    if not known:
        return []
    cached = train.select("label", features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cached.count()
        inherit = inheritable_thread_target(train.sparkSession)
        fit = inherit(lambda name: fit_one(name, lambda: _FITTERS[name](cached, features=features, **known[name])))
        with ThreadPoolExecutor(max_workers=len(known)) as pool:
            models = list(pool.map(fit, known))
    finally:
        cached.unpersist()
    return [FittedModel(name, model, position) for position, (name, model) in enumerate(zip(known, models))]


def sigmoid(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def class_one_score(model: Model, probability: str = "probability", raw: str = "rawPrediction") -> Column:
    """Probability of class 1; models without probabilities use the sigmoid of their margin."""
    if isinstance(model, LinearSVCModel):
        return sigmoid(vector_to_array(raw)[1])
    return vector_to_array(probability)[1]


def predict(fitted: FittedModel, df: DataFrame, keys: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """``(keys, model, prediction, score)`` of one model."""
    return fitted.model.transform(df).select(
        *keys,
        F.lit(fitted.name).alias("model"),
        F.col("prediction").cast("int").alias("prediction"),
        class_one_score(fitted.model).alias("score"),
    )


def predict_all(fitted: Sequence[FittedModel], df: DataFrame, keys: Sequence[str] = ("doc_id", "label")) -> DataFrame:
    """All models' predictions in long form, from one pass over the rows."""
    outputs = ("prediction", "probability", "rawPrediction")
    answers = []
    for item in fitted:
        names = {output: f"_{output}_{item.position}" for output in outputs}
        model = item.model.copy().setPredictionCol(names["prediction"]).setRawPredictionCol(names["rawPrediction"])
        if not isinstance(model, LinearSVCModel):
            model = model.setProbabilityCol(names["probability"])
        df = model.transform(df)
        answers.append(
            F.struct(
                F.lit(item.name).alias("model"),
                F.col(names["prediction"]).cast("int").alias("prediction"),
                class_one_score(model, names["probability"], names["rawPrediction"]).alias("score"),
            )
        )
    return df.select(*keys, F.explode(F.array(*answers)).alias("answer")).select(*keys, "answer.*")


def linear_scores(cells: DataFrame, weights: DataFrame, intercept: float, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A linear model as a query: ``cells(keys, idx, value)`` joined to ``weights(idx, weight)``; label 1 above 0."""
    margin = F.coalesce(F.sum(F.col("value") * F.col("weight")), F.lit(0.0)) + F.lit(intercept)
    met = lookup_join(cells, settle(weights, "weights"), "idx", keys, "left")
    scored = met.groupBy(*keys).agg(margin.alias("margin"))
    return scored.withColumn("prediction", (F.col("margin") > 0).cast("int")).withColumn("score", sigmoid(F.col("margin")))


def feature_importance(fitted: FittedModel, vocabulary: DataFrame) -> DataFrame | None:
    """``(term, importance)``: coefficients of a linear model, importances of a forest, otherwise None."""
    model = fitted.model
    if hasattr(model, "coefficients"):
        values = model.coefficients
    elif isinstance(model, RandomForestClassificationModel):
        values = model.featureImportances
    else:
        return None
    # one number per vocabulary entry, which the model holds on the driver anyway; they leave it as one column of numbers
    numbers = values.toArray()
    table = vocabulary.sparkSession.createDataFrame(pa.table({"idx": pa.array(range(len(numbers)), pa.int32()), "importance": pa.array(numbers, pa.float64())}))
    return vocabulary.join(table, "idx").select("term", "importance")
