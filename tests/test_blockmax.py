"""Block-max search against brute force: segments, blocks that are passed over, zero scores, written index, many queries."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexispark.operators import blockmax, ranking
from lexispark.operators.blockmax import Asked, Best, Gain, Segment

GAIN = Gain(1.5, 0.75, 6.0)


def brute(texts, ids, query):
    """Score of each document, in plain loops."""
    found = {}
    for i, words in zip(ids, texts):
        found[i] = sum(w * GAIN.of(np.array(words.count(t)), np.array(len(words))) for t, w in query.items())
    return found


@pytest.fixture
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    texts = [rng.choices(words, [1 / (i + 1) for i in range(40)], k=rng.randint(0, 12)) for _ in range(150)]
    texts[30] = texts[31] = texts[90]
    queries = [{rng.choice(words): rng.uniform(0.1, 4) for _ in range(rng.randint(0, 5))} for _ in range(60)]
    queries += [{"w0": -1.0, "w1": -0.5}, {"w0": 0.0}, {"unknown": 2.0}, {}, {"w39": 3.0, "w0": -2.0}]
    return texts, queries


def asked(queries):
    rows = [(q, t, w) for q, terms in enumerate(queries) for t, w in terms.items()]
    table = pa.table({"query_id": pa.array([r[0] for r in rows], pa.int64()), "term": pa.array([r[1] for r in rows], pa.string()), "weight": pa.array([r[2] for r in rows], pa.float64())})
    return Asked.of(pa.table({"query_id": pa.array(range(len(queries)), pa.int64())}), table)


@pytest.mark.parametrize("k", [1, 5, 200])
@pytest.mark.parametrize("name", [int, "doc{:04d}".format])
def test_best_of_all_segments(corpus, monkeypatch, k, name):
    monkeypatch.setattr(blockmax, "BLOCK_DOCS", 4)
    texts, queries = corpus
    ids = [name(i) for i in random.Random(1).sample(range(1000), len(texts))]
    wanted = asked(queries)
    best = Best(len(queries), k)
    for a in range(0, len(texts), 40):
        segment, _ = Segment.of_texts(pa.array(ids[a : a + 40]), pa.array(texts[a : a + 40], pa.list_(pa.string())), GAIN, wanted.terms)
        best.meet(segment, wanted)
    for q, query in enumerate(queries):
        scores = brute(texts, ids, query)
        want = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:k]
        found_scores, found_ids = best.found[q]
        got = sorted(zip(found_scores.tolist(), found_ids.tolist()), key=lambda x: (-round(x[0], 9), x[1]))
        assert [i for _, i in got] == want
        assert [s for s, _ in got] == pytest.approx([scores[i] for i in want])


@pytest.mark.parametrize("k", [1, 5, 200])
@pytest.mark.parametrize("name", [int, "doc{:04d}".format])
@pytest.mark.parametrize("cells, tabled, lead", [(1 << 18, 1 << 22, 512), (300, 200, 8), (1, 0, 2)])
def test_batches_of_queries(corpus, monkeypatch, k, name, cells, tabled, lead):
    for bound, value in (("_CELLS", cells), ("_TABLED", tabled), ("_LEAD", lead), ("_POSTINGS", 30)):
        monkeypatch.setattr(blockmax, bound, value)
    texts, queries = corpus
    ids = [name(i) for i in random.Random(1).sample(range(1000), len(texts))]
    wanted = asked(queries)
    crowd = blockmax.Crowd(wanted, k)
    for a in range(0, len(texts), 40):
        crowd.meet(Segment.of_texts(pa.array(ids[a : a + 40]), pa.array(texts[a : a + 40], pa.list_(pa.string())), GAIN, wanted.terms)[0])
    found: dict[int, list] = {}
    for q, score, i in zip(*(x.tolist() for x in crowd.found)):
        found.setdefault(q, []).append((i, score))
    for q, query in enumerate(queries):
        scores = brute(texts, ids, query)
        want = sorted(scores, key=lambda i: (-round(scores[i], 9), i))[:k]
        assert [i for i, _ in found[q]] == want
        assert [s for _, s in found[q]] == pytest.approx([scores[i] for i in want])


def test_a_task_emits_a_query_once_however_many_splits_there_are(spark):
    docs = spark.createDataFrame([(i, f"a{i % 7} b c") for i in range(500)], "doc_id int, processed string")
    model = ranking.fit_bm25(docs)
    asks = docs.selectExpr("doc_id AS query_id", "processed AS query")
    cores = spark.sparkContext.defaultParallelism
    read, sets = blockmax.texts_reader(model.gain), model._asked(asks, "query")
    texts = model._texts(docs.repartition(5 * cores), "doc_id")
    best = blockmax.searched(texts, read, sets, asks.schema["query_id"].dataType, docs.schema["doc_id"].dataType, "doc_id", 2)
    assert best.groupBy("query_id").count().agg(F.max("count")).first()[0] <= 2 * cores


def test_blocks_without_a_chance_are_not_scored(monkeypatch):
    monkeypatch.setattr(blockmax, "BLOCK_DOCS", 8)
    texts = [["a"] * (9 if i == 50 else 1) + ["b"] * (40 if i != 50 else 0) for i in range(400)]
    wanted = asked([{"a": 1.0}])
    segment, _ = Segment.of_texts(pa.array(range(400)), pa.array(texts), GAIN, wanted.terms)
    scored = []
    real = Segment.scored
    monkeypatch.setattr(Segment, "scored", lambda self, blocks, weights: scored.append(len(blocks)) or real(self, blocks, weights))
    best = Best(1, 1)
    best.add(0, np.array([0.5]), np.array([1000]))
    best.meet(segment, wanted)
    assert best.found[0][1].tolist() == [50] and sum(scored) == 1 < len(segment.block)
    best.meet(segment, asked([{"a": 0.1}]))  # the whole segment is passed over
    assert sum(scored) == 1


def test_slices_are_bounded(monkeypatch):
    monkeypatch.setattr(blockmax, "SEGMENT_TOKENS", 5)
    monkeypatch.setattr(blockmax, "SEGMENT_DOCS", 3)
    tokens = [["x"]] * 4 + [["x"] * 9, [], ["x"] * 4, ["x"] * 2]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(tokens))), pa.array(tokens, pa.list_(pa.string()))], ["id", "t"])
    assert [ids.to_pylist() for ids, _ in blockmax._cut(batch)] == [[0, 1, 2], [3], [4], [5, 6], [7]]


def test_ten_thousand_queries(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(300)], k=rng.randint(0, 30))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, processed string").repartition(5)
    queries = [" ".join(rng.choices([*words, "unknown"], k=rng.randint(0, 4))) for _ in range(10_000)]
    asks = spark.createDataFrame([(i if i else None, q) for i, q in enumerate(queries)], "query_id int, query string")
    model = ranking.fit_bm25(docs)
    monkeypatch.setattr(blockmax, "QUERY_SET", 9_000)  # several sets
    ranked = model.rank(docs, asks, 3)
    found = {}
    for r in ranked.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["doc_id"], round(r["score"], 6)))
    idf = {r["term"]: r["idf"] for r in model.terms.collect()}
    split = [t.split() for t in texts]
    length = np.array([len(t) for t in split])
    gains = {w: model.gain.of(np.array([t.count(w) for t in split]), length) for w in idf}
    for q, query in enumerate(queries):
        scores = sum((idf.get(t, 0) * gains.get(t, np.zeros(400)) for t in query.split()), np.zeros(400))
        want = np.lexsort((np.arange(400), -np.round(scores, 9)))[:3]
        assert found[q or None] == [(i, round(scores[i], 6)) for i in want.tolist()]
    by_index = model.index(docs).rank(asks, 3)
    rounded = [F.col("query_id"), F.col("rank"), F.col("doc_id"), F.round("score", 6)]
    assert sorted(map(str, by_index.select(*rounded).collect())) == sorted(map(str, ranked.select(*rounded).collect()))


def test_index_rows_are_small_and_meet_again_as_segments(spark, monkeypatch):
    """A reader holds a row group of an index at once, so its rows do not grow to whole segments."""
    docs = spark.createDataFrame([((i * 7) % 200, f"a{i % 7} b" + " c" * (i % 3)) for i in range(200)], "doc_id int, processed string").coalesce(1)
    asks = spark.createDataFrame([(1, "a1 b"), (2, "c"), (3, "unknown")], "query_id int, query string")
    model = ranking.fit_bm25(docs)
    monkeypatch.setattr(blockmax, "ROW_TOKENS", 50)
    index = model.index(docs)
    assert index.table.agg(F.max(F.aggregate("docs", F.lit(0), lambda n, _: n + 1))).first()[0] <= 50 and index.table.count() > 8
    met = []
    for tokens in (120, 1 << 20):  # several segments, and one
        held = index.table.toArrow().to_batches()
        monkeypatch.setattr(blockmax, "SEGMENT_TOKENS", tokens)
        met.append(sum(1 for _ in blockmax.index_reader(iter(held), asked([{"b": 1.0}]))))
    assert met[0] > 2 and met[1] == 1
    rounded = [F.col("query_id"), F.col("rank"), F.col("doc_id"), F.round("score", 6)]
    plain = model.rank(docs, asks, 4).select(*rounded).collect()
    assert sorted(map(str, index.rank(asks, 4).select(*rounded).collect())) == sorted(map(str, plain)) and len(plain) == 12


def test_no_pair_of_query_and_document_is_exchanged(spark):
    docs = spark.createDataFrame([(i, f"a{i % 7} b c") for i in range(50)], "doc_id int, processed string")
    asks = spark.createDataFrame([(1, "a1 b"), (2, "")], "query_id int, query string")
    model = ranking.fit_bm25(docs)
    plan = model.rank(docs, asks, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(query_id" in plan and "WindowGroupLimit" in plan
    assert "Exchange" not in model.scores(docs, asks)._jdf.queryExecution().executedPlan().toString()
    assert {r["query_id"]: r["doc_id"] for r in model.rank(docs, asks, 1).collect()} == {1: 1, 2: 0}
    assert model.rank(docs, asks.limit(0), 3).collect() == []
    assert model.summary(docs, asks.limit(0)).first()["n_nonzero"] == 0
