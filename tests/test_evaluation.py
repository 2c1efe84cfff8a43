"""Metrics, votes, models, the model store, the run log and the training run."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from lexispark.config import TrainConfig, VectorConfig
from lexispark.operators import metrics, models, prep, scale, voting
from lexispark.plans import training
from lexispark.sources import model_store, run_log, text_tables


def answers(spark, rows, model="m"):
    data = [(i, model, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id int, model string, label int, prediction int, score double")


def python_auc(pairs):
    wins = [1.0 if p > n else 0.5 if p == n else 0.0 for y, p in pairs if y for z, n in pairs if not z]
    return sum(wins) / len(wins)


def test_auc_with_ties_and_skew(spark):
    rng = random.Random(5)
    # one score holds a third of all rows
    rows = [(int(rng.random() < 0.4), 0, 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(600)]
    found = metrics.auc(answers(spark, rows)).first()["auc_score"]
    assert found == pytest.approx(python_auc([(y, s) for y, _, s in rows]))


def test_auc_is_null_for_one_class(spark):
    assert metrics.auc(answers(spark, [(1, 1, 0.2), (1, 0, 0.4)])).first()["auc_score"] is None
    both = answers(spark, [(1, 1, None), (0, 0, None)])
    assert metrics.auc(both).first()["auc_score"] is None


def test_metrics_of_a_class_never_predicted(spark):
    row = metrics.evaluate(answers(spark, [(0, 1, 0.1), (1, 1, 0.9), (1, 1, 0.8), (0, 1, 0.3)])).first()
    assert (row["accuracy"], row["precision"], row["recall"]) == (0.5, 0.25, 0.5)
    assert row["f1"] == pytest.approx(1 / 3) and row["auc_score"] == 1.0


def test_confusion_is_complete(spark, rows):
    df = answers(spark, [(0, 1, 0.1), (0, 1, 0.2), (1, 1, 0.9)])
    assert rows(metrics.confusion(df)) == [("m", 0, 0, 0), ("m", 0, 1, 2), ("m", 1, 0, 0), ("m", 1, 1, 1)]
    assert rows(metrics.confusion_normalized(df).select("label", "prediction", "share"))[1] == (0, 1, 1.0)


def test_report_layout(spark):
    report = metrics.classification_report(answers(spark, [(0, 0, 0.1), (0, 1, 0.6), (1, 1, 0.9)])).orderBy("line")
    found = [tuple(r)[1:] for r in report.collect()]
    assert found == [
        (1, "0", 1.0, 0.5, 0.67, 2),
        (2, "1", 0.5, 1.0, 0.67, 1),
        (3, "accuracy", None, None, 0.67, 3),
        (4, "macro avg", 0.75, 0.75, 0.67, 3),
        (5, "weighted avg", 0.83, 0.67, 0.67, 3),
    ]


def long_form(spark, votes):
    rows = [(d, 1, f"m{i}", v, s) for d, vs in enumerate(votes) for i, (v, s) in enumerate(vs)]
    return spark.createDataFrame(rows, "doc_id int, label int, model string, prediction int, score double")


def test_votes(spark, rows):
    df = long_form(spark, [[(0, 0.4), (1, 0.6)], [(1, 0.9), (1, 0.8), (0, 0.0)], [(1, None), (1, 0.6)]])
    assert rows(voting.ensemble(df).select("doc_id", "prediction")) == [(0, 0), (1, 1), (2, 1)]
    averaged = rows(voting.ensemble(df, "average_proba").select("doc_id", "prediction"))
    assert averaged == [(0, 0), (1, 1), (2, 1)]  # a mean of exactly one half is class 0
    with pytest.raises(ValueError):
        voting.ensemble(df, "weighted")
    with pytest.raises(Exception, match="without any score"):
        voting.average_score(long_form(spark, [[(1, None)]])).collect()


def test_best_model_first_added_wins(spark):
    data = [("b", 1, 0.5, 0.7, None), ("a", 2, 0.5, 0.7, 0.9), ("c", 0, 0.1, 0.2, None)]
    table = spark.createDataFrame(data, "model string, position int, accuracy double, f1 double, auc_score double")
    assert metrics.best_model(table)["model"] is not None
    assert metrics.best_model(table).first()["model"] == "b"
    assert metrics.best_model(table, "auc_score").first()["model"] == "a"
    with pytest.raises(ValueError):
        metrics.best_model(table, "speed")


@pytest.fixture(scope="module")
def reviews(spark):
    """Separable texts from two sources; one word decides the label."""
    rng = random.Random(2)
    filler = [f"word{i}" for i in range(40)]
    data = []
    for i in range(240):
        label = int(i % 3 > 0)
        words = [*rng.choices(filler, k=8), "good" if label else "bad", "great" if label else "awful"]
        data.append(("tweets" if i % 2 else "reviews", i, " ".join(words) if i % 40 else None, label))
    return training.fill_text(spark.createDataFrame(data, "source string, doc_id int, processed string, label int"), "processed")


CONFIG = TrainConfig(
    vectorizer_config=VectorConfig(max_features=500),
    classifiers={
        "logistic_regression": {"C": 10.0, "max_iter": 200},
        "svm": {"C": 1.0, "max_iter": 200},
        "random_forest": {"n_estimators": 20, "max_depth": 5},
        "perceptron": {},
    },
)


@pytest.fixture(scope="module")
def run(spark, reviews, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    result = training.run_training(spark, reviews, CONFIG, f"{root}/models", f"{root}/runs")
    return result, str(root)


def test_training_run(spark, run):
    result, root = run
    assert [m.name for m in result.models] == ["logistic_regression", "svm", "random_forest"]
    table = {r["model"]: r for r in result.metrics.collect()}
    assert set(table) == {"logistic_regression", "svm", "random_forest", "ensemble"}
    assert all(r["accuracy"] > 0.9 for r in table.values()) and table["ensemble"]["auc_score"] is None
    assert result.metadata.first().asDict() == {
        "dataset_size": 240,
        "train_size": 192,
        "test_size": 48,
        "vectorizer": "tfidf",
        "vocab_size": result.bag.vocabulary.size,
        "num_classifiers": 4,
    }
    scores = result.predictions.agg(F.min("score"), F.max("score"), F.count("*")).first()
    assert 0 <= scores[0] and scores[1] <= 1 and scores[2] == 3 * 48


def test_runs_are_recorded(spark, run):
    result, root = run
    found = {r["name"]: r for r in run_log.search_runs(spark, f"{root}/runs", "sentiment-classification").collect()}
    assert set(found) == {"full_pipeline", "logistic_regression", "svm", "random_forest", "ensemble"}
    assert found["svm"]["parent_id"] == result.run_id and found["svm"]["n_artifacts"] == 2  # the report and the model
    # the vote's four metrics, and five of each model
    assert found["ensemble"]["n_metrics"] == 4 + 3 * 5 and found["svm"]["n_metrics"] == 5
    assert {r["status"] for r in found.values()} == {"FINISHED"} and found["full_pipeline"]["n_artifacts"] == 1
    assert run_log.run_counts(spark, f"{root}/runs").first()["n_runs"] == 5


def test_a_failed_run_goes_on(spark, reviews, tmp_path, monkeypatch):
    paths = {}
    for source in ("reviews", "tweets"):
        paths[source] = f"{tmp_path}/{source}"
        text_tables.write_processed(reviews.where(F.col("source") == source).drop("source"), paths[source])
    config = TrainConfig(vectorizer_config=VectorConfig(max_features=50), classifiers={"svm": {"C": 1.0}})
    call = lambda: training.run_files(spark, paths, config, sample_size=90, run_path=f"{tmp_path}/runs")
    folder = f"{scale.work_dir(spark)}/lexispark".removeprefix("file:")
    before = {f for f in os.listdir(folder) if f.startswith("run-")}

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(training, "evaluate_vote", broken)
        with pytest.raises(RuntimeError, match="lost"):
            call()
    counts = {r["status"]: r["n_runs"] for r in run_log.run_counts(spark, f"{tmp_path}/runs").collect()}
    assert counts == {"FAILED": 1}
    assert len({f for f in os.listdir(folder) if f.startswith("run-")} - before) == 1

    # what is finished is read: neither split nor fit happens again
    monkeypatch.setattr(training, "stratified_split", broken)
    monkeypatch.setattr(models, "_FITTERS", {"svm": broken})
    result = call()
    assert result.metadata.first()["dataset_size"] == 180 and len(result.metrics.collect()) == 2
    found = {r["name"]: r for r in run_log.search_runs(spark, f"{tmp_path}/runs", "sentiment-classification").collect()}
    assert found["full_pipeline"]["status"] == "FINISHED" and found["svm"]["parent_id"] == found["full_pipeline"]["run_id"] == result.run_id
    assert {f for f in os.listdir(folder) if f.startswith("run-")} == before  # nothing is left of the scope
    monkeypatch.undo()
    other = training.run_files(spark, paths, config, sample_size=30)
    assert other.metadata.first()["dataset_size"] == 60 and other.run_id is None


def test_saved_ensemble_predicts_the_same(spark, reviews, run, rows):
    result, root = run
    fresh = model_store.score_saved(spark, f"{root}/models", reviews, ("source", "doc_id", "label"))
    columns = ["source", "doc_id", "model", "prediction", F.round("score", 9).alias("score")]
    test = result.predictions.select("source", "doc_id")
    again = fresh.join(test.distinct(), ["source", "doc_id"])
    assert rows(again.select(*columns)) == rows(result.predictions.select(*columns))


def test_linear_model_as_a_query(spark, reviews, run, rows):
    result, _ = run
    names = result.bag.vocabulary.feature_names()
    for model in result.models[:2]:
        importance = models.feature_importance(model, names)
        weights = importance.join(names, "term").select("idx", F.col("importance").alias("weight"))
        cells = result.bag.long_form(reviews)
        as_query = models.linear_scores(cells, weights, model.model.intercept).select("doc_id", "prediction")
        own = models.predict(model, result.bag.transform(reviews), ("doc_id",)).select("doc_id", "prediction")
        assert rows(as_query) == rows(own)
    forest = models.feature_importance(result.models[2], names)
    assert forest.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert forest.orderBy(F.desc("importance")).first()["term"] in ("good", "bad", "great", "awful")


def test_vectorizer_sees_training_rows_only(spark):
    split = spark.createDataFrame(
        [(1, "aa bb", "train"), (2, "aa bb", "train"), (3, "cc cc aa", "test"), (4, "cc", "test")], "doc_id int, processed string, split string"
    )
    bag, _ = training.vectorize_split(split, TrainConfig(vectorizer="bow", vectorizer_config=VectorConfig(max_df=1.0)))
    assert [r["term"] for r in bag.vocabulary.feature_names().orderBy("idx").collect()] == ["aa", "bb"]
    with pytest.raises(ValueError):
        training.vectorize_split(split, TrainConfig(vectorizer="bm25"))


def test_sigmoid(spark):
    values = spark.createDataFrame([(0.0,), (2.0,)], "x double").select(models.sigmoid(F.col("x"))).collect()
    assert [v[0] for v in values] == pytest.approx([0.5, 1 / (1 + math.exp(-2))])


def test_csv_round_trips(spark, tmp_path, rows):
    texts = [("plain", 1), ('say "hi", ok', 0), ("", 1), (None, 0), ("back\\slash é", 1)]
    df = spark.createDataFrame(texts, "processed string, label int")
    text_tables.write_processed(df, str(tmp_path / "p"))
    expected = sorted(((t or None, label) for t, label in texts), key=repr)
    assert rows(text_tables.read_processed(spark, str(tmp_path / "p"))) == expected

    (tmp_path / "reviews.csv").write_text('Id,Text,Score\n1,"a ""b"",\nsecond line",5\n2,,3\n3, spaced ,\n')
    reviews = text_tables.read_reviews(spark, str(tmp_path / "reviews.csv"))
    assert reviews.columns == ["Text", "Score"]
    assert rows(reviews) == sorted([('a "b",\nsecond line', 5), (None, 3), (" spaced ", None)], key=repr)

    (tmp_path / "tweets.csv").write_bytes('"4","12345678901","Mon Apr 06","NO_QUERY","me","caf\xe9 & co"\n'.encode("latin-1"))
    tweet = text_tables.read_tweets(spark, str(tmp_path / "tweets.csv")).first()
    assert tuple(tweet) == (4, 12345678901, "Mon Apr 06", "NO_QUERY", "me", "café & co")


def test_ids_are_unique_and_stay(spark, rows):
    named = prep.identify(spark.range(500).repartition(5).select(F.col("id").alias("value")))
    assert named.select("doc_id").distinct().count() == 500
    assert rows(named) == rows(named)


def test_load_sources(spark, rows):
    one = spark.createDataFrame([(2, "b", 1), (1, None, 0), (3, "c", 1)], "doc_id int, processed string, label int")
    both = training.load_sources({"reviews": one, "tweets": one}, 2)
    assert rows(both.select("source", "doc_id", "processed")) == [
        ("reviews", 1, ""),
        ("reviews", 2, "b"),
        ("tweets", 1, ""),
        ("tweets", 2, "b"),
    ]
