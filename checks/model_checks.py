"""M and E: models, voting, evaluation and the training run. What depends on a solver has no SQL twin."""

import uuid
from dataclasses import asdict
from functools import lru_cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.base import LABELLED_SQL, PREDICTIONS_SQL, check, labelled, predictions, table
from checks.table_checks import split_sql, written_results
from checks.vector_checks import CTES, beyond, fitted, texts, vocabulary_ctes
from lexispark.config import TrainConfig
from lexispark.operators import metrics, models, vectors, voting
from lexispark.operators.scale import settle, work_dir
from lexispark.plans import training
from lexispark.sources import model_store, run_log, text_tables

TRAIN = TrainConfig()


# ------------------------------------------------------------------ models: one split and one fit per folder
@lru_cache(maxsize=2)
def trained(spark, folder):
    rows = training.stratified_split(labelled(spark, folder), "label", TRAIN.test_size, TRAIN.random_state, training.KEYS)
    split = settle(rows, "split")
    bag, features = training.vectorize_split(split, TRAIN)
    train = features.where(F.col("split") == "train")
    return bag, features, models.fit_all(TRAIN.classifiers, train, TRAIN.random_state)


def model_of(spark, folder, name):
    bag, features, fitted_models = trained(spark, folder)
    return next(m for m in fitted_models if m.name == name), features, bag


def scored(name):
    def query(spark, folder):
        model, features, _ = model_of(spark, folder, name)
        return models.predict(model, features, ("source", "doc_id", "label"))

    return query


check("m01_logistic_regression")(scored("logistic_regression"))
check("m02_linear_svm")(scored("svm"))
check("m03_random_forest")(scored("random_forest"))

WEIGHTS = "((idx % 7) - 3) / 10.0::DOUBLE"
LINEAR_SQL = f"""{CTES}, margins AS (
    SELECT a.doc_id, coalesce(sum(v * {WEIGHTS}), 0) + 0.05 AS margin FROM ana a
    LEFT JOIN tfidf t ON a.doc_id = t.doc_id GROUP BY a.doc_id)"""


@check(
    "m04_predict_from_weights",
    f"{LINEAR_SQL} SELECT doc_id, round(margin, 6) AS margin, (margin > 0)::INT AS prediction FROM margins",
)
def predict_from_weights(spark, folder):
    model = fitted(spark, folder)
    weights = model.vocabulary.table.select("idx", ((F.col("idx") % 7 - 3) / F.lit(10.0)).alias("weight"))
    result = models.linear_scores(model.long_form(texts(spark, folder)), weights, 0.05)
    return result.select("doc_id", F.round("margin", 6).alias("margin"), "prediction")


@check("m04_predict")
def predict(spark, folder):
    """The linear model's own prediction next to the one from its weight table."""
    model, features, bag = model_of(spark, folder, "svm")
    weights = models.feature_importance(model, bag.vocabulary.feature_names())
    weights = weights.join(bag.vocabulary.feature_names(), "term").select("idx", F.col("importance").alias("weight"))
    own = models.predict(model, features, ("doc_id",)).select("doc_id", "prediction")
    cells = bag.long_form(labelled(spark, folder))
    table_ = models.linear_scores(cells, weights, model.model.intercept)
    return own.join(table_.select("doc_id", F.col("prediction").alias("from_weights"), "margin"), "doc_id")


@check("m05_sigmoid", "SELECT doc_id, round(1 / (1 + exp(-(n_chars - 1000) / 500.0::DOUBLE)), 6) AS score FROM documents")
def sigmoid(spark, folder):
    margin = (F.col("n_chars") - 1000) / F.lit(500.0)
    return table(spark, folder, "documents").select("doc_id", F.round(models.sigmoid(margin), 6).alias("score"))


@check("m05_probabilities")
def probabilities(spark, folder):
    model, features, _ = model_of(spark, folder, "logistic_regression")
    both = vector_to_array("probability")
    return model.model.transform(features).select("doc_id", both[0].alias("p0"), both[1].alias("p1"))


@check("m06_feature_importance")
def feature_importance(spark, folder):
    bag, _, fitted_models = trained(spark, folder)
    names = bag.vocabulary.feature_names()
    tables = [models.feature_importance(m, names).withColumn("model", F.lit(m.name)) for m in fitted_models]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def fit_all(spark, folder):
    bag, _, fitted_models = trained(spark, folder)
    rows = [(m.position, m.name, m.model.numFeatures, bag.vocabulary.size) for m in fitted_models]
    return spark.createDataFrame(rows, "position int, model string, n_features int, vocab_size int")


@check("m08_predict_all")
def predict_all(spark, folder):
    _, features, fitted_models = trained(spark, folder)
    return models.predict_all(fitted_models, features, ("source", "doc_id", "label"))


VOTE_SQL = f"""SELECT doc_id, label, prediction FROM (
    SELECT doc_id, label, prediction, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, prediction) AS nr
    FROM ({PREDICTIONS_SQL}) GROUP BY doc_id, label, prediction) WHERE nr = 1"""


check("m09_majority_vote", VOTE_SQL)(lambda s, f: voting.majority_vote(predictions(s, f)))


@check(
    "m10_average_probability",
    f"""SELECT doc_id, label, round(avg(score), 6) AS score, (avg(score) > 0.5)::INT AS prediction
        FROM ({PREDICTIONS_SQL}) GROUP BY doc_id, label""",
)
def average_probability(spark, folder):
    return voting.average_score(predictions(spark, folder)).withColumn("score", F.round("score", 6))


# ------------------------------------------------------------------ saving and scoring
@lru_cache(maxsize=2)
def saved(spark, folder):
    path = f"{work_dir(spark)}/lexispark/models-{uuid.uuid4().hex}"
    bag, _, fitted_models = trained(spark, folder)
    model_store.save_ensemble(bag, fitted_models, path)
    return path


@check("s06_joined_save_and_score")
def joined_save_and_score(spark, folder):
    """Models behind a vocabulary that is saved as a table, loaded and applied."""
    bag, _, fitted_models = trained(spark, folder)
    path = f"{work_dir(spark)}/lexispark/models-{uuid.uuid4().hex}"
    model_store.save_ensemble(beyond(bag), fitted_models, path)
    return model_store.score_saved(spark, path, labelled(spark, folder), ("source", "doc_id", "label"))


@check("s07_score_saved")
def score_saved(spark, folder):
    return model_store.score_saved(spark, saved(spark, folder), labelled(spark, folder), ("source", "doc_id", "label"))


# ------------------------------------------------------------------ evaluation
def given(spark, folder):
    """``toxic`` taken as the answer to ``quality``."""
    rows = table(spark, folder, "labels")
    return rows.select(F.lit("given").alias("model"), F.col("quality").alias("label"), F.col("toxic").alias("prediction"))


GIVEN_SQL = "SELECT 'given' AS model, quality AS label, toxic AS prediction FROM labels"


def confusion_sql(rows):
    return f"""SELECT l.model, l.c AS label, p.c AS prediction, count(r.label) AS n
    FROM (SELECT DISTINCT model, unnest([label, prediction]) AS c FROM ({rows})) l
    JOIN (SELECT DISTINCT model, unnest([label, prediction]) AS c FROM ({rows})) p ON l.model = p.model
    LEFT JOIN ({rows}) r ON r.model = l.model AND r.label = l.c AND r.prediction = p.c GROUP BY ALL"""


check("e01_confusion", confusion_sql(GIVEN_SQL))(lambda s, f: metrics.confusion(given(s, f)))


@check(
    "e02_confusion_normalized",
    f"""SELECT model, label, prediction, n, round(n / sum(n) OVER (PARTITION BY model, label), 6) AS share
        FROM ({confusion_sql(PREDICTIONS_SQL)})""",
)
def confusion_normalized(spark, folder):
    return metrics.confusion_normalized(predictions(spark, folder)).withColumn("share", F.round("share", 6))


def class_sql(rows):
    return f"""SELECT c.model, c.c AS class, count(*) FILTER (label = c.c) AS support,
      coalesce(count(*) FILTER (label = c.c AND prediction = c.c) / nullif(count(*) FILTER (prediction = c.c), 0), 0) AS p,
      coalesce(count(*) FILTER (label = c.c AND prediction = c.c) / nullif(count(*) FILTER (label = c.c), 0), 0) AS r,
      2 * count(*) FILTER (label = c.c AND prediction = c.c)
        / (count(*) FILTER (prediction = c.c) + count(*) FILTER (label = c.c)) AS f
    FROM (SELECT DISTINCT model, unnest([label, prediction]) AS c FROM ({rows})) c JOIN ({rows}) r ON r.model = c.model
    GROUP BY c.model, c.c"""


def weighted_sql(rows, digits=6):
    return f"""SELECT a.model, round(accuracy, {digits}) AS accuracy, round(sum(p * support) / sum(support), {digits}) AS precision,
      round(sum(r * support) / sum(support), {digits}) AS recall, round(sum(f * support) / sum(support), {digits}) AS f1
    FROM ({class_sql(rows)}) c JOIN (
      SELECT model, count(*) FILTER (label = prediction) / count(*) AS accuracy FROM ({rows}) GROUP BY model) a
      ON a.model = c.model GROUP BY a.model, accuracy"""


def rounded(df, *columns, digits=6):
    for column in columns:
        df = df.withColumn(column, F.round(column, digits))
    return df


for _name, _metric, _function in (
    ("e03_accuracy", "accuracy", metrics.accuracy),
    ("e04_weighted_precision", "precision", metrics.weighted_precision),
    ("e05_weighted_recall", "recall", metrics.weighted_recall),
    ("e06_weighted_f1", "f1", metrics.weighted_f1),
):
    check(_name, f"SELECT model, {_metric} FROM ({weighted_sql(GIVEN_SQL)})")(
        lambda s, f, metric=_metric, function=_function: rounded(function(given(s, f)), metric)
    )

AUC_SQL = f"""SELECT model, CASE WHEN pos > 0 AND pos < n THEN round((up - pos * (pos + 1) / 2) / (pos * (n - pos)), 6) END AS auc_score
FROM (SELECT model, count(*) AS n, count(*) FILTER (label = 1) AS pos, sum(place) FILTER (label = 1) AS up
  FROM (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
          + (count(*) OVER (PARTITION BY model, score) - 1) / 2 AS place FROM ({PREDICTIONS_SQL})) GROUP BY model)"""

check("e07_auc", AUC_SQL)(lambda s, f: rounded(metrics.auc(predictions(s, f)), "auc_score"))

CHARS = "SELECT 'length' AS model, l.quality AS label, d.n_chars / 100000.0::DOUBLE AS score FROM documents d JOIN labels l USING (doc_id)"


@check("e07_auc_of_length", AUC_SQL.replace(PREDICTIONS_SQL, CHARS))
def auc_of_length(spark, folder):
    chars = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    score = F.col("n_chars") / F.lit(100000.0)
    return rounded(
        metrics.auc(chars.select(F.lit("length").alias("model"), F.col("quality").alias("label"), score.alias("score"))),
        "auc_score",
    )


REPORT_SQL = f"""WITH c AS ({class_sql(PREDICTIONS_SQL)}), w AS ({weighted_sql(PREDICTIONS_SQL, 12)}),
  n AS (SELECT model, count(*) AS classes, sum(support)::BIGINT AS support, avg(p) AS p, avg(r) AS r, avg(f) AS f FROM c GROUP BY model)
SELECT model, (row_number() OVER (PARTITION BY model ORDER BY class))::INT AS line, class::VARCHAR AS name,
       round(p, 2) AS precision, round(r, 2) AS recall, round(f, 2) AS f1, support FROM c
UNION ALL SELECT model, (classes + 1)::INT, 'accuracy', NULL, NULL, round(accuracy, 2), support FROM n JOIN w USING (model)
UNION ALL SELECT model, (classes + 2)::INT, 'macro avg', round(p, 2), round(r, 2), round(f, 2), support FROM n
UNION ALL SELECT model, (classes + 3)::INT, 'weighted avg', round(precision, 2), round(recall, 2), round(f1, 2), support
          FROM n JOIN w USING (model)"""

check("e08_classification_report", REPORT_SQL)(lambda s, f: metrics.classification_report(predictions(s, f)))

ALL_SQL = f"""SELECT model, accuracy, precision, recall, f1, auc_score
              FROM ({weighted_sql(PREDICTIONS_SQL)}) JOIN ({AUC_SQL}) USING (model)"""
NUMBERS = metrics.METRICS


@check("e09_evaluate", f"SELECT * FROM ({ALL_SQL}) WHERE model = 'alpha'")
def evaluate(spark, folder):
    return rounded(metrics.evaluate(predictions(spark, folder).where(F.col("model") == "alpha")), *NUMBERS)


check("e10_evaluate_all", ALL_SQL)(lambda s, f: rounded(metrics.evaluate_all(predictions(s, f)), *NUMBERS))


@check("e11_best_model", f"SELECT model, f1 FROM ({ALL_SQL}) ORDER BY f1 DESC, model LIMIT 1")
def best_model(spark, folder):
    found = metrics.evaluate_all(predictions(spark, folder)).withColumn("position", F.col("model"))
    return rounded(metrics.best_model(found).select("model", "f1"), "f1")


@check("e12_metrics_summary", f"UNPIVOT ({ALL_SQL}) ON accuracy, precision, recall, f1, auc_score INTO NAME metric VALUE value")
def metrics_summary(spark, folder):
    return rounded(metrics.metrics_summary(metrics.evaluate_all(predictions(spark, folder))), "value")


VOTED = f"SELECT 'ensemble' AS model, label, prediction FROM ({VOTE_SQL})"
ENSEMBLE_SQL = f"SELECT *, NULL::DOUBLE AS auc_score FROM ({weighted_sql(VOTED)})"

check("e13_evaluate_vote", ENSEMBLE_SQL)(lambda s, f: rounded(metrics.evaluate_vote(predictions(s, f)), *NUMBERS))
check("e14_comparison_table", f"{ALL_SQL} UNION ALL BY NAME {ENSEMBLE_SQL}")(
    lambda s, f: rounded(metrics.comparison_table(predictions(s, f)), *NUMBERS)
)

check("s05_write_results", f"{ALL_SQL} UNION ALL BY NAME {ENSEMBLE_SQL}")(lambda s, f: rounded(written_results(s, f), *NUMBERS))

# ------------------------------------------------------------------ the training run
SPLIT_SQL = split_sql(LABELLED_SQL, "'42|' || source || '|' || doc_id")
TRAIN_CTES = "WITH sp AS (" + SPLIT_SQL + "), " + vocabulary_ctes("SELECT doc_id, processed AS text FROM sp WHERE split = 'train'")


check(
    "m07_fit_all",
    f"""{TRAIN_CTES} SELECT position::INT AS position, model, (SELECT count(*) FROM vocab)::INT AS n_features, (SELECT count(*) FROM vocab)::INT AS vocab_size
        FROM (VALUES {", ".join(f"({at}, '{name}')" for at, name in enumerate(TRAIN.classifiers))}) m(position, model)""",
)(fit_all)


def _manifest_sql() -> str:
    """A row for each model, in their order, all behind the analyzer of the run's settings."""
    config = asdict(TRAIN.vectorizer_config)
    rows = ", ".join(f"({at}, '{name}')" for at, name in enumerate(TRAIN.classifiers))
    return f"SELECT position::INT AS position, name, 'processed' AS text, {config['max_features']} AS max_features, {config['min_df']} AS min_df FROM (VALUES {rows}) m(position, name)"


@check("s06_save_models", _manifest_sql())
def save_models(spark, folder):
    settings = F.col("settings")
    number = lambda key: F.get_json_object(settings, f"$.analyzer.{key}").cast("int").alias(key)
    return model_store.manifest(spark, saved(spark, folder)).select("position", "name", F.get_json_object(settings, "$.text").alias("text"), number("max_features"), number("min_df"))


@check(
    "e15_training_metadata",
    f"""{TRAIN_CTES} SELECT count(*) AS dataset_size, count(*) FILTER (split = 'train') AS train_size,
        count(*) FILTER (split = 'test') AS test_size, 'tfidf' AS vectorizer,
        (SELECT count(*) FROM vocab) AS vocab_size, 3::BIGINT AS num_classifiers FROM sp""",
)
def training_metadata(spark, folder):
    bag, features, _ = trained(spark, folder)
    return training.training_metadata(features, bag, TRAIN)


VECTORIZE_SQL = f"""{TRAIN_CTES},
    words AS (SELECT doc_id, split, unnest(list_filter(string_split_regex(strip_accents(lower(processed)),
              '[^\\p{{L}}\\p{{N}}_]+'), lambda w: length(w) >= 2)) AS term FROM sp),
    cells AS (SELECT doc_id, split, idx, count(*) * any_value(idf) AS w FROM words JOIN vocab USING (term) GROUP BY ALL)
    SELECT sp.doc_id, sp.split, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY sp.doc_id)), 6) AS value
    FROM sp LEFT JOIN cells c ON c.doc_id = sp.doc_id"""


def split_cells(features):
    cells = features.select("doc_id", "split", F.explode_outer(vectors.stored_values("features")).alias("c"))
    return cells.select("doc_id", "split", "c.idx", F.round("c.value", 6).alias("value"))


check("e16_vectorize_split", VECTORIZE_SQL)(lambda s, f: split_cells(trained(s, f)[1]))


@check("e16_joined_vectorize_split", VECTORIZE_SQL)
def joined_vectorize_split(spark, folder):
    bag, features, _ = trained(spark, folder)
    return split_cells(beyond(bag).transform(features.drop("features")))


METRIC_NAMES = ("accuracy", "precision", "recall", "f1", "auc_score")


def _recorded_sql() -> str:
    """Every entry of a run: name, parent's name, kind and key; the values of the parameters."""
    quoted = lambda *row: "(" + ", ".join("NULL" if x is None else f"'{x}'" for x in row) + ")"
    rows = [quoted("full_pipeline", None, "artifact", "training_metadata.json", None)]
    rows += [quoted("full_pipeline", None, "run", "name", "full_pipeline")] * 2  # running, finished
    for name, params in TRAIN.classifiers.items():
        rows += [quoted(name, "full_pipeline", "param", key, value) for key, value in params.items()]
        rows += [quoted(name, "full_pipeline", "metric", key, None) for key in METRIC_NAMES]
        rows += [quoted(name, "full_pipeline", "artifact", key, None) for key in ("classification_report.txt", name)]
        rows += [quoted(name, "full_pipeline", "run", "name", name)]
        rows += [quoted("ensemble", "full_pipeline", "metric", f"{name}/{key}", None) for key in METRIC_NAMES]
    rows += [quoted("ensemble", "full_pipeline", "metric", f"ensemble_{key}", None) for key in METRIC_NAMES[:-1]]
    rows += [quoted("ensemble", "full_pipeline", "run", "name", "ensemble")]
    return f"""{TRAIN_CTES}, meta AS (
      SELECT count(*)::VARCHAR AS dataset_size, count(*) FILTER (split = 'train')::VARCHAR AS train_size, count(*) FILTER (split = 'test')::VARCHAR AS test_size,
             'tfidf' AS vectorizer, (SELECT count(*) FROM vocab)::VARCHAR AS vocab_size, '3' AS num_classifiers FROM sp)
    SELECT 'full_pipeline' AS name, NULL AS parent, 'param' AS kind, key, value
    FROM (UNPIVOT meta ON dataset_size, train_size, test_size, vectorizer, vocab_size, num_classifiers INTO NAME key VALUE value)
    UNION ALL SELECT * FROM (VALUES {", ".join(rows)}) t(name, parent, kind, key, value)"""


@check("e17_train_and_record", _recorded_sql())
def train_and_record(spark, folder):
    """The whole run from written files; its result is what the run log holds afterwards."""
    root = f"{work_dir(spark)}/lexispark/training-{uuid.uuid4().hex}"
    text_tables.write_processed(labelled(spark, folder), f"{root}/processed", "parquet")
    sources = [r[0] for r in labelled(spark, folder).select("source").distinct().collect()]  # a file for each source
    paths = {source: f"{root}/processed/source={source}" for source in sources}
    training.run_files(spark, paths, TRAIN, None, f"{root}/models", f"{root}/runs", format="parquet")
    runs = run_log.read_runs(spark, f"{root}/runs")
    names = runs.where("kind = 'run'").select(F.col("run_id").alias("parent_id"), F.col("name").alias("parent")).distinct()
    value = F.when(F.col("kind").isin("param", "run"), F.col("value"))
    return runs.join(names, "parent_id", "left").select("name", "parent", "kind", "key", value.alias("value"))
