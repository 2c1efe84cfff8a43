"""The building blocks for scale give the exact result also on skewed data and on their second path."""

import random

import pytest
from pyspark.sql import functions as F

from lexispark.config import VectorConfig
from lexispark.operators import prep, profile, scale, vectors, vocabulary


@pytest.fixture(scope="module")
def skewed(spark):
    """One source holds nine tenths of the rows."""
    return spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        (F.col("id") * 7919 % 3001).alias("value"),
    )


def test_running_totals_equal_a_plain_sum(spark, skewed):
    found = scale.running_totals(skewed, [F.col("value")], {"total": F.col("doc_id")}, ["source"])
    data = [tuple(r) for r in skewed.collect()]
    expected = {}
    for source in {d[1] for d in data}:
        total = 0
        for doc_id, _, _value in sorted((d for d in data if d[1] == source), key=lambda d: d[2]):
            total += doc_id
            expected[doc_id] = total
    assert {r["doc_id"]: r["total"] for r in found.collect()} == expected


def test_number_rows(spark, skewed):
    numbered = scale.number_rows(skewed, [F.col("value").desc()], "n").orderBy("n").collect()
    assert [r["n"] for r in numbered] == list(range(1, 3001))
    assert [r["value"] for r in numbered] == sorted((r["value"] for r in numbered), reverse=True)


def test_first_rows_is_the_same_on_both_paths(spark, skewed, monkeypatch, rows):
    short = rows(scale.first_rows(skewed, [F.col("value")], 50, "rank", ["source"]))
    monkeypatch.setattr(scale, "TASK_LOCAL_TOP_K", 10)
    assert rows(scale.first_rows(skewed, [F.col("value")], 50, "rank", ["source"]).select(skewed.columns + ["rank"])) == short


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_is_the_same_salted(spark, skewed, rows, how):
    lookup = scale.settle(spark.createDataFrame([("hot", 1), ("s0", 2)], "source string, w int"), "lookup")
    broadcast = scale.lookup_join(skewed, lookup, "source", ["doc_id"], how, broadcast=True)
    salted = scale.lookup_join(skewed, lookup, "source", ["doc_id"], how, broadcast=False)
    assert rows(salted.select(broadcast.columns)) == rows(broadcast)


def test_broadcast_needs_a_measured_size(spark, monkeypatch):
    table = scale.settle(spark.range(100).select(F.col("id").cast("string").alias("term")), "t")
    assert scale.fits_broadcast(table)
    monkeypatch.setattr(scale, "MAX_BROADCAST_ROWS", 99)
    assert not scale.fits_broadcast(table)


def test_settled_tables_go_to_the_session_folder(spark):
    folder = scale.work_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir", None) in (folder, None)
    table = scale.settle(spark.range(3), "three")
    assert all(folder.split(":")[-1] in path for path in table.inputFiles())


def test_vocabulary_is_the_same_on_both_paths(spark, monkeypatch, rows):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame(
        [(i, " ".join(["common", *rng.choices(words, k=rng.randint(0, 30))])) for i in range(200)], "doc_id int, processed string"
    )
    cfg = VectorConfig(max_features=120, max_df=1.0)
    small = vectors.fit_bag(docs, cfg)
    assert small.vocabulary.small
    for module in (vocabulary, scale):
        monkeypatch.setattr(module, "MAX_BROADCAST_ROWS", 50)
    large = vectors.fit_bag(docs, cfg)
    assert not large.vocabulary.small
    assert rows(large.vocabulary.table) == rows(small.vocabulary.table)
    assert large.transform(docs).select("features").first().features.size == large.vocabulary.size

    def cells(df):
        return rows(df.select("doc_id", "idx", F.round("value", 9).alias("value")))

    assert cells(large.long_form(docs)) == cells(small.long_form(docs))


def test_exact_split_of_a_skewed_class(spark):
    df = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 > 0).cast("int").alias("label"))
    split = prep.stratified_split(df, test_size=0.25, seed=1)
    counts = {(r["split"], r["label"]): r["count"] for r in split.groupBy("split", "label").count().collect()}
    assert counts == {("test", 0): 25, ("test", 1): 225, ("train", 0): 75, ("train", 1): 675}
    again = prep.stratified_split(df.repartition(7), test_size=0.25, seed=1)
    assert split.exceptAll(again).isEmpty()
    assert not split.exceptAll(prep.stratified_split(df, test_size=0.25, seed=2)).isEmpty()


def test_split_rounds_up_and_keeps_shares(spark):
    df = spark.createDataFrame([(i, int(i >= 3)) for i in range(10)], "doc_id int, label int")
    quotas = {r["label"]: r["quota"] for r in prep.holdout_quotas(df, "label", 0.25).collect()}
    assert quotas == {0: 1, 1: 2}  # ceil(2.5) = 3 rows, shares 0.9 and 2.1
    with pytest.raises(ValueError):
        prep.stratified_split(df, test_size=1.5)


def test_sample_is_the_head_of_the_shuffle(spark, skewed):
    shuffled = prep.shuffle(skewed, 5).where("position < 40").select(skewed.columns)
    assert prep.sample_n(skewed, 40, 5).exceptAll(shuffled).isEmpty()
    assert prep.sample_n(skewed, 9999, 5).count() == 3000
    assert prep.sample_n(skewed, 0, 5).isEmpty()


def test_labels_of_missing_values(spark, rows):
    df = spark.createDataFrame([(1, 4), (2, 3), (3, None)], "doc_id int, score int")
    assert rows(prep.label_threshold(df, "score", 4).select("doc_id", "label")) == [(1, 1), (2, 0), (3, 0)]
    assert rows(prep.label_equals(df, "score", 4).select("doc_id", "label")) == [(1, 1), (2, 0), (3, 0)]


def test_histogram_of_one_length(spark, rows):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("b", 0), ("b", 10)], "source string, n_tokens int")
    found = rows(profile.length_histogram(df, 10).select("source", "bin", "n"))
    assert found == [("a", 5, 2), ("b", 0, 1), ("b", 9, 1)]


def test_top_tokens_skip_missing_texts(spark, rows):
    df = spark.createDataFrame([("x", "b a a"), ("x", None), ("x", "b c")], "source string, processed string")
    assert rows(profile.top_tokens(df, 2).select("rank", "term", "count")) == [(1, "a", 2), (2, "b", 2)]


def test_null_groups_stay_beyond_the_task_local_limit(spark):
    from lexispark.operators import prep

    rows = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, NULL, 'a') AS source")
    for n in (1000, 1001):
        got = dict(map(tuple, prep.head_per_source(rows, n).groupBy("source").count().collect()))
        assert got == {"a": n, None: 1000}


def test_split_counts_null_labels_as_a_class(spark):
    from lexispark.operators import prep

    rows = spark.range(1000).selectExpr("id AS doc_id", "IF(id % 5 = 0, NULL, id % 2) AS label")
    split = prep.stratified_split(rows).where("split = 'test'").groupBy("label").count()
    assert dict(map(tuple, split.collect())) == {None: 40, 0: 80, 1: 80}


def test_rows_with_equal_keys_are_kept_apart(spark):
    from lexispark.config import VectorConfig, review_config
    from lexispark.operators import normalize, vectors

    rows = spark.createDataFrame([(1, "boxes boxes dogs"), (1, "cats boxes"), (None, "dogs"), (1, "boxes boxes dogs")], "doc_id bigint, text string")
    done = normalize.process(rows, "text", review_config(), lexicon=spark.createDataFrame([("box",), ("dog",), ("cat",)], "form string"))
    assert sorted(r["processed"] for r in done.collect()) == ["box box dog", "box box dog", "cat box", "dog"]
    steps = normalize.explain_steps(rows, "text", review_config(), lexicon=spark.createDataFrame([("box",), ("dog",), ("cat",)], "form string"))
    assert sorted((r["original"], r["final"]) for r in steps.collect())[-1] == ("dogs", "dog") and steps.count() == 4
    model = vectors.fit_bag(done, VectorConfig(min_df=1, max_df=1.0), "tfidf")
    cells = lambda df: sorted((r["doc_id"] is None, r["idx"], round(r["value"], 9)) for r in df.collect())
    assert cells(model.joined_form(done)) == cells(model.long_form(done))


def test_one_row_group_is_dealt_to_all_splits(spark, tmp_path):
    """A file of one row group has many splits, all but one of them empty."""
    one, even = f"{tmp_path}/one", f"{tmp_path}/even"
    wide = spark.range(4000).select("id", F.repeat(F.md5(F.col("id").cast("string")), 8).alias("text"))
    wide.coalesce(1).write.parquet(one)
    wide.repartition(40).write.parquet(even)
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for key in before:
            spark.conf.set(key, "16384")
        scan = spark.read.parquet(one)
        splits = scan.rdd.getNumPartitions()
        assert splits >= spark.sparkContext.defaultParallelism  # enough splits, so that their number alone says nothing
        dealt = scale.spread(scan)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 2 * 4000 / splits + 8
        assert dealt.exceptAll(scan).isEmpty()
        for key in before:
            spark.conf.set(key, "1m")
        many = spark.read.parquet(even)
        assert many.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and scale.spread(many) is many
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
