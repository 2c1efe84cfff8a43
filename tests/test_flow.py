"""From raw files to ranked documents and trained models, the way a user goes."""

import random

from pyspark.sql import functions as F

from lexispark.config import TrainConfig, VectorConfig, review_config, tweet_config
from lexispark.operators import normalize, prep, profile, ranking
from lexispark.plans.training import load_sources, run_training
from lexispark.sources import text_tables


def test_raw_files_to_models(spark, tmp_path):
    rng = random.Random(1)
    words = ["box", "boxes", "price", "taste", "order", "friend", "coffee", "dog"]

    def text(good):
        return " ".join([*rng.choices(words, k=6), "loved" if good else "hated", "it's" if good else "didn't"])

    lines = ["Id,Text,Score"]
    lines += [f'{i},"{text(i % 5 > 1)} <br/> ""{i}""",{5 if i % 5 > 1 else 2}' for i in range(120)] + ["120,,4"]
    (tmp_path / "reviews.csv").write_text("\n".join(lines))
    tweets = [f'"{4 if i % 2 else 0}","{i}","Mon","NO_QUERY","u{i}","@u{i} {text(i % 2)} www.x.y #tag"' for i in range(120)]
    (tmp_path / "tweets.csv").write_bytes("\n".join(tweets).encode("latin-1"))

    raw = prep.drop_incomplete(text_tables.read_reviews(spark, str(tmp_path / "reviews.csv")), ["Text", "Score"])
    reviews = prep.identify(prep.label_threshold(raw, "Score", 4))
    short = prep.label_equals(text_tables.read_tweets(spark, str(tmp_path / "tweets.csv")), "polarity", 4)
    processed = {
        "reviews": normalize.process(reviews, "Text", review_config(), keys=["doc_id", "label"]),
        "tweets": normalize.process(
            short.withColumnRenamed("id", "doc_id"), "text", tweet_config(), keys=["doc_id", "label"]
        ),
    }
    # boxes becomes box, as both are corpus terms; numbers stay in reviews only
    terms = {r["term"] for r in profile.token_frequencies(processed["reviews"], []).collect()}
    assert {"box", "loved", "17"} <= terms and not {"boxes", "br", "quot"} & terms
    assert not processed["tweets"].where(F.col("processed").rlike("boxes|www|@|\\d")).count()

    rows = load_sources(processed)
    assert rows.count() == 240
    queries = spark.createDataFrame([(1, "17 coffee")], "query_id int, query string")
    best = ranking.fit_bm25(processed["reviews"]).rank(processed["reviews"], queries, 3)
    joined = best.join(processed["reviews"], "doc_id").orderBy("rank").collect()
    assert len(joined) == 3 and "17" in joined[0]["processed"].split()

    config = TrainConfig(
        vectorizer_config=VectorConfig(max_features=200),
        classifiers={"logistic_regression": {"C": 10.0, "max_iter": 100}},
    )
    result = run_training(spark, rows, config)
    assert all(r["accuracy"] > 0.95 for r in result.metrics.collect())
    assert result.metadata.first()["test_size"] == 48
