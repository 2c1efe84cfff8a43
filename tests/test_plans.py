"""The physical plans are the ones meant for large tables."""

import pytest
from pyspark.sql import functions as F

from lexispark.config import VectorConfig, review_config
from lexispark.functions.tokens import filtered_tokens, term_bag
from lexispark.operators import models, normalize, prep, profile, ranking, vectors, voting


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "docs")
    rows = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.concat_ws(" ", F.lit("common words"), F.concat(F.lit("w"), F.col("id") % 37)).alias("processed"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.lit("unused").alias("other"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_text_work_is_one_projection(docs):
    text = plan(docs.select("doc_id", term_bag(filtered_tokens(F.col("processed"), review_config()))))
    assert "Exchange" not in text and "Python" not in text
    assert "ReadSchema: struct<doc_id:bigint,processed:string>" in text


def test_vectors_need_no_shuffle(docs):
    model = vectors.fit_bag(docs, VectorConfig(max_features=50))
    text = plan(model.long_form(docs))
    assert "Exchange" not in text and "Join" not in text and "Python" not in text


def test_top_rows_are_pruned_before_the_shuffle(docs):
    text = plan(profile.top_tokens(docs, 5))
    assert text.index("Final") < text.index("hashpartitioning(source") < text.index("Partial")
    assert text.count("WindowGroupLimit") == 2


def test_split_does_not_shuffle_the_table(docs):
    text = plan(prep.stratified_split(docs.select("doc_id", "label")))
    assert "hashpartitioning" not in text and "BroadcastHashJoin" in text and "Sort " not in text


def test_scores_need_no_exchange(docs):
    queries = docs.select(F.col("doc_id").alias("query_id"), F.col("processed").alias("query")).limit(3)
    text = plan(ranking.fit_bm25(docs).scores(docs, queries))
    assert "Exchange" not in text and "hashpartitioning" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_terms_are_replaced_inside_the_row(docs):
    text = plan(normalize.process(docs, "processed", review_config()))
    assert "posexplode" not in text and "Exchange" not in text and "ArrowEvalPython" in text


def test_terms_beyond_the_bounds_are_replaced_with_one_shuffle(docs, monkeypatch):
    monkeypatch.setattr("lexispark.operators.scale.MAX_BROADCAST_ROWS", -1)
    text = plan(normalize.process(docs, "processed", review_config()))
    # before the tokens are exploded, not after
    assert text.count("hashpartitioning(_row") == 1
    assert text.index("Generate posexplode") < text.index("hashpartitioning(_row")


def test_a_shuffled_text_crosses_one_exchange(docs, monkeypatch):
    monkeypatch.setattr("lexispark.operators.prep.BUCKET_ROWS", 20)
    conf, name = docs.sparkSession.conf, "spark.sql.autoBroadcastJoinThreshold"
    before = conf.get(name)
    try:
        for rows, threshold, exchanges in ((1_000_000, before, 1), (0, "-1", 2)):  # the second one is that of the bucket starts
            monkeypatch.setattr("lexispark.operators.scale.MAX_BROADCAST_ROWS", rows)
            conf.set(name, threshold)
            shuffled = prep.shuffle(docs, 1)
            moved = [line for line in plan(shuffled).splitlines() if "Exchange hashpartitioning" in line or "Exchange range" in line]
            assert len(moved) == exchanges and all("_bucket" in line for line in moved)
            assert sorted(r["position"] for r in shuffled.collect()) == list(range(docs.count()))
    finally:
        conf.set(name, before)


def test_cosine_keeps_only_the_top_rows(docs):
    model = vectors.fit_bag(docs, VectorConfig(max_features=50))
    text = plan(ranking.cosine_topk(docs, model, 3, 5))
    assert "TakeOrderedAndProject(limit=5" in text and "NestedLoop" not in text


def test_vote_is_one_aggregation(docs):
    votes = docs.select("doc_id", "label", F.lit("m").alias("model"), F.col("label").alias("prediction"))
    assert plan(voting.majority_vote(votes)).count("hashpartitioning") == 1


def test_all_models_predict_in_one_pass(docs):
    model = vectors.fit_bag(docs, VectorConfig(max_features=50))
    vecs = model.transform(docs)
    fitted = models.fit_all({"logistic_regression": {"max_iter": 5}, "svm": {"max_iter": 5}}, vecs)
    text = plan(models.predict_all(fitted, vecs))
    assert text.count("FileScan") == 1 and "Exchange" not in text
