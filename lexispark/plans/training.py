"""The training run: load, split, vectorize on the training rows, fit, evaluate, vote, save and record."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.config import TrainConfig
from lexispark.operators.metrics import classification_report, evaluate_all, evaluate_vote, metrics_summary
from lexispark.operators.models import FittedModel, fit_all, predict_all
from lexispark.operators.prep import combine, fill_text, head_per_source, stratified_split
from lexispark.operators.scale import settle
from lexispark.operators.vectors import BagModel, fit_bag
from lexispark.plans.run_scope import RunScope, files_of
from lexispark.sources import text_tables
from lexispark.sources.model_store import save_ensemble
from lexispark.sources.run_log import append_entries, new_run_id, run_entries

KEYS = ("source", "doc_id")


def load_sources(frames: Mapping[str, DataFrame], sample_size: int | None = None) -> DataFrame:
    """Combine processed sources, on request only the first ``sample_size`` rows of each; missing text becomes ''."""
    rows = combine(frames)
    if sample_size:
        rows = head_per_source(rows, sample_size)
    return fill_text(rows, "processed")


def vectorize_split(split: DataFrame, config: TrainConfig) -> tuple[BagModel, DataFrame]:
    """Fit the vectorizer on the training rows only and transform all rows."""
    bag = fit_bag(split.where(F.col("split") == "train"), config.vectorizer_config, config.vectorizer)
    return bag, bag.transform(split)


def training_metadata(split: DataFrame, bag: BagModel, config: TrainConfig) -> DataFrame:
    return split.agg(
        F.count("*").alias("dataset_size"),
        F.count_if(F.col("split") == "train").alias("train_size"),
        F.count_if(F.col("split") == "test").alias("test_size"),
    ).select(
        "*",
        F.lit(config.vectorizer).alias("vectorizer"),
        F.lit(bag.vocabulary.size).cast("bigint").alias("vocab_size"),
        F.lit(len(config.classifiers)).cast("bigint").alias("num_classifiers"),
    )


@dataclass(frozen=True)
class TrainingResult:
    bag: BagModel
    models: list[FittedModel]
    predictions: DataFrame
    metrics: DataFrame
    metadata: DataFrame
    run_id: str | None


def _report_text(report: list, name: str) -> str:
    """The report as the usual plain-text table."""
    lines = [f"{'':>12} {'precision':>9} {'recall':>9} {'f1-score':>9} {'support':>9}", ""]
    for row in sorted((r for r in report if r["model"] == name), key=lambda r: r["line"]):
        cells = [f"{row[m]:>9.2f}" if row[m] is not None else " " * 9 for m in ("precision", "recall", "f1")]
        lines += ["", ""] if row["name"] == "accuracy" else []
        lines.append(f"{row['name']:>12} {' '.join(cells)} {row['support']:>9}")
    return "\n".join(lines)


def read_sources(spark: SparkSession, paths: Mapping[str, str], sample_size: int | None = None, format: str = "csv") -> DataFrame:
    """Processed files to training rows, by source. Rows of files without ids are numbered in the order of the file."""
    frames = {}
    for source, path in paths.items():
        df = text_tables.read_processed(spark, path, format)
        df = df if "doc_id" in df.columns else df.withColumn("doc_id", F.monotonically_increasing_id())
        frames[source] = df.select("doc_id", "processed", "label")
    return load_sources(frames, sample_size)


def run_files(
    spark: SparkSession,
    paths: Mapping[str, str],
    config: TrainConfig = TrainConfig(),
    sample_size: int | None = None,
    model_path: str | None = None,
    run_path: str | None = None,
    experiment: str = "sentiment-classification",
    format: str = "csv",
) -> TrainingResult:
    """The whole run from written files, on request from the first ``sample_size`` rows of each.

    The same call after a failure goes on with the stages that are missing: they are known by the files' names, lengths
    and times and by the settings.
    """
    key = {"files": files_of(spark, paths.values()), "sources": sorted(paths), "sample": sample_size, "config": _plain(config), "format": format}
    rows = lambda: read_sources(spark, paths, sample_size, format)
    return _run(spark, rows, key, config, model_path, run_path, experiment)


def run_training(
    spark: SparkSession,
    rows: DataFrame,
    config: TrainConfig = TrainConfig(),
    model_path: str | None = None,
    run_path: str | None = None,
    experiment: str = "sentiment-classification",
) -> TrainingResult:
    """The run over rows ``(source, doc_id, processed, label)``. A DataFrame has no name to be known by, so it starts anew."""
    return _run(spark, lambda: rows, {"call": new_run_id()}, config, model_path, run_path, experiment)


def _plain(config: TrainConfig) -> dict:
    return {"seed": config.random_state, "test": config.test_size, "vectorizer": config.vectorizer, "vector": asdict(config.vectorizer_config), "models": {k: dict(v) for k, v in config.classifiers.items()}}


def _run(
    spark: SparkSession, rows: Callable[[], DataFrame], key: Mapping, config: TrainConfig, model_path: str | None, run_path: str | None, experiment: str
) -> TrainingResult:
    """Each model is fitted and evaluated once. What the result holds is kept after the scope's folder is gone."""
    with RunScope(spark, experiment, "full_pipeline", key, run_path) as run:
        loaded = run.table("rows", rows)
        # the split is written once: vocabulary, features and metadata all see the same rows
        split = run.table("split", lambda: stratified_split(loaded, "label", config.test_size, config.random_state, KEYS))
        bag, vectors = vectorize_split(split, config)
        made = vectors
        vectors = run.table("vectors", lambda: made)
        is_train = F.col("split") == "train"
        train = vectors.where(is_train)
        fitted = fit_all(config.classifiers, train, config.random_state, fit_one=lambda name, fit: run.model(f"model-{name}", fit))
        predictions = run.table("predictions", lambda: predict_all(fitted, vectors.where(~is_train), (*KEYS, "label")))
        vote = evaluate_vote(predictions, (*KEYS, "label"))
        metrics = run.table("metrics", lambda: evaluate_all(predictions).unionByName(vote))
        metadata = run.table("metadata", lambda: training_metadata(split, bag, config))
        if model_path:
            save_ensemble(bag, fitted, model_path)
        if run_path:
            _record(spark, run, run_path, experiment, config, fitted, predictions, metrics, metadata, model_path)
        kept = [settle(df, name) for df, name in ((predictions, "predictions"), (metrics, "metrics"), (metadata, "metadata"))]
    return TrainingResult(bag, fitted, *kept, run.run_id if run_path else None)


def _record(spark, run: RunScope, run_path: str, experiment: str, config: TrainConfig, fitted, predictions: DataFrame, metrics: DataFrame, metadata: DataFrame, model_path: str | None) -> None:
    """A run for each model and one for the vote below the run itself. A handful of rows: one for each model and metric."""
    values = metrics_summary(metrics).collect()
    report = classification_report(predictions).collect()
    described = metadata.first().asDict()
    whole = run_entries(experiment, run.name, described, artifacts={"training_metadata.json": json.dumps(described)}, run_id=run.run_id, status="RUNNING")
    entries = [e for e in whole if e[5] != "run"]  # the scope records the run itself
    for item in fitted:
        found = {"auc_score": 0} | {v["metric"]: v["value"] for v in values if v["model"] == item.name}
        artifacts = {"classification_report.txt": _report_text(report, item.name)}
        artifacts |= {item.name: f"{model_path}/models/{item.name}"} if model_path else {}
        entries += run_entries(experiment, item.name, config.classifiers[item.name], found, artifacts, run.run_id)
    voted = {f"{v['model']}/{v['metric']}": v["value"] for v in values if v["model"] != "ensemble"}
    voted |= {f"ensemble_{v['metric']}": v["value"] for v in values if v["model"] == "ensemble"}
    entries += run_entries(experiment, "ensemble", None, voted, parent_id=run.run_id)
    append_entries(spark, run_path, entries)
