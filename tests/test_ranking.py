"""Vectors, BM25 and cosine against hand-computed values and brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexispark.config import VectorConfig
from lexispark.operators import ranking, vectors, vocabulary
from lexispark.operators.comparison import fit_methods

ANY = VectorConfig(min_df=1, max_df=1.0)


def corpus(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, processed string")


def asks(spark, *queries):
    return spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")


@pytest.fixture(scope="module")
def toy(spark):
    return corpus(spark, "hello world", "hello python world")


@pytest.fixture(scope="module")
def random_docs(spark):
    """Zipf-like words; one word is in nine of ten texts, several texts are copies or empty."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    texts = [" ".join(["the"] * (i % 10 > 0) + rng.choices(words, weights, k=rng.randint(0, 15))) for i in range(80)]
    texts[20] = texts[21] = texts[22]
    texts[40] = ""
    return texts


def test_counts_and_tfidf_of_the_toy_corpus(spark, toy, rows):
    bow = vectors.fit_bag(toy, ANY, "bow")
    assert rows(bow.vocabulary.feature_names()) == [(0, "hello"), (1, "python"), (2, "world")]
    assert rows(bow.long_form(toy)) == [(0, 0, 1.0), (0, 2, 1.0), (1, 0, 1.0), (1, 1, 1.0), (1, 2, 1.0)]
    rare = math.log(3 / 2) + 1
    norm = math.sqrt(2 + rare * rare)
    weights = {(r[0], r[1]): r[2] for r in vectors.fit_bag(toy, ANY).long_form(toy).collect()}
    assert weights[0, 0] == pytest.approx(1 / math.sqrt(2))
    assert weights[1, 1] == pytest.approx(rare / norm) and weights[1, 2] == pytest.approx(1 / norm)


def test_pruning_and_its_errors(spark, rows):
    docs = corpus(spark, "aa bb", "aa bb cc", "aa cc cc", "aa dd")
    kept = vocabulary.fit_vocabulary(docs, "processed", VectorConfig(max_features=1, min_df=2, max_df=0.9))
    assert rows(kept.table.select("term", "df", "cf")) == [("cc", 2, 3)]
    with pytest.raises(ValueError):
        vocabulary.fit_vocabulary(docs, "processed", VectorConfig(min_df=4, max_df=0.9))
    with pytest.raises(ValueError):
        vocabulary.fit_vocabulary(docs, "processed", VectorConfig(min_df=3, max_df=0.9))
    with pytest.raises(ValueError):
        vectors.fit_bag(docs, ANY, "word2vec")


def test_unknown_terms_and_zero_rows(spark, toy, rows):
    model = vectors.fit_bag(toy, ANY, "BOW")
    fresh = corpus(spark, "nothing known", None, "Wörld world")
    # accents fold to the known term
    assert rows(model.long_form(fresh)) == [(0, None, None), (1, None, None), (2, 2, 2.0)]


def python_bm25(texts, query, k1=1.5, b=0.75, epsilon=0.25):
    docs = [t.split() for t in texts]
    mean = sum(map(len, docs)) / len(docs)
    df = Counter(t for d in docs for t in set(d))
    idf = {t: math.log(len(docs) - n + 0.5) - math.log(n + 0.5) for t, n in df.items()}
    average = sum(idf.values()) / len(idf)
    idf = {t: epsilon * average if v < 0 else v for t, v in idf.items()}
    scores = []
    for d in docs:
        tf = Counter(d)
        scores.append(
            sum(idf.get(q, 0) * tf[q] * (k1 + 1) / (tf[q] + k1 * (1 - b + b * len(d) / mean)) for q in query.split())
        )
    return scores


def test_bm25_of_the_toy_corpus(spark, toy):
    """Both common words are in more than half of the texts, so the replacement of negative idf decides."""
    texts = [r["processed"] for r in toy.orderBy("doc_id").collect()]
    model = ranking.fit_bm25(toy)
    found = {r["doc_id"]: r["score"] for r in model.scores(toy, asks(spark, "hello python python")).collect()}
    assert [found[0], found[1]] == pytest.approx(python_bm25(texts, "hello python python"))


@pytest.mark.parametrize("k", [5, None])
def test_bm25_rank_equals_brute_force(spark, random_docs, k):
    queries = ["w0 w3 w3", "the", "unknown", "w50 w59 unknown", ""]
    docs = corpus(spark, *random_docs)
    ranked = ranking.fit_bm25(docs).rank(docs, asks(spark, *queries), k).orderBy("query_id", "rank").collect()
    for query_id, query in enumerate(queries):
        scores = python_bm25(random_docs, query)
        expected = sorted(range(len(scores)), key=lambda i: (-round(scores[i], 9), i))[: k or len(scores)]
        mine = [r for r in ranked if r["query_id"] == query_id]
        assert [r["doc_id"] for r in mine] == expected
        assert [r["score"] for r in mine] == pytest.approx([scores[i] for i in expected])


def test_bm25_rank_on_the_long_path(spark, random_docs, monkeypatch, rows):
    docs, queries = corpus(spark, *random_docs), asks(spark, "w0 w3", "unknown")
    model = ranking.fit_bm25(docs)
    short = rows(model.rank(docs, queries, 20))
    monkeypatch.setattr("lexispark.operators.scale.TASK_LOCAL_TOP_K", 5)
    monkeypatch.setattr("lexispark.operators.scale.MAX_BROADCAST_ROWS", 0)
    assert [r[:3] for r in rows(model.rank(docs, queries, 20))] == [r[:3] for r in short]


def test_bm25_summary_counts_zero_pairs(spark, random_docs):
    queries = ["w0 w3", "unknown", "w50"]
    scores = [s for q in queries for s in python_bm25(random_docs, q)]
    docs = corpus(spark, *random_docs)
    row = ranking.fit_bm25(docs).summary(docs, asks(spark, *queries)).first()
    assert row["n_pairs"] == len(scores) and row["n_nonzero"] == sum(s != 0 for s in scores)
    assert row["mean_score"] == pytest.approx(sum(scores) / len(scores)) and row["max_score"] == pytest.approx(max(scores))


def test_similar_documents(spark, random_docs):
    docs = corpus(spark, *random_docs)
    best = ranking.fit_bm25(docs).similar(docs, 21, 3).orderBy("rank").collect()
    assert [r["doc_id"] for r in best] == [20, 21, 22]  # the document itself and its copies, ties by id


@pytest.mark.parametrize("method", ["bow", "tfidf"])
def test_cosine_equals_brute_force(spark, random_docs, method):
    docs = corpus(spark, *random_docs)
    model = vectors.fit_bag(docs, VectorConfig(min_df=2), method)
    cells = {}
    for r in model.long_form(docs).where("idx IS NOT NULL").collect():
        cells.setdefault(r["doc_id"], {})[r["idx"]] = r["value"]
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))

    def similarity(i):
        a, b = cells[21], cells.get(i, {})
        return sum(a[k] * b[k] for k in a.keys() & b.keys()) / (norm(a) * norm(b)) if b else 0.0

    sims = {i: similarity(i) for i in range(len(random_docs)) if i != 21}
    expected = sorted(sims, key=lambda i: (-round(sims[i], 9), i))
    found = ranking.cosine_topk(docs, model, 21, len(random_docs)).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == expected
    assert [r["similarity"] for r in found] == pytest.approx([sims[i] for i in expected])
    near = docs.where("doc_id < 30")
    few = ranking.cosine_topk(docs, model, 21, 3, candidates=near).orderBy("rank").collect()
    assert [r["doc_id"] for r in few] == [i for i in expected if i < 30][:3]


def test_top_terms_and_sparsity(spark, toy, rows):
    model = vectors.fit_bag(toy, ANY)
    vecs = model.transform(toy)
    assert rows(vectors.top_terms(vecs, model.vocabulary, 1).select("doc_id", "term")) == [(0, "hello"), (1, "python")]
    assert vectors.sparsity(vecs, 3).first()["sparsity"] == pytest.approx(1 / 6)
    assert rows(vectors.dense_vectors(vecs).select(F.size("dense"))) == [(3,), (3,)]


def test_methods_side_by_side(spark, toy, rows):
    fitted = fit_methods(toy, "processed", VectorConfig(min_df=2, max_df=1.0))
    assert rows(fitted.vocabulary_sizes()) == [("BM25", 3), ("BOW", 2), ("TF-IDF", 2)]
    compared = fitted.compare_document(toy, 1, 1).collect()
    weights = {(r["method"], r["n_nonzero"], r["term"]): r["weight"] for r in compared}
    # the idf of python is exactly 0, so it gives BM25 no feature; the other two are tied
    part = python_bm25(["hello world", "hello python world"], "hello")[1]
    assert weights == pytest.approx(
        {("BOW", 2, "hello"): 1.0, ("TF-IDF", 2, "hello"): 1 / math.sqrt(2), ("BM25", 2, "hello"): part}
    )


def test_vectors_of_any_vocabulary_size(spark, toy, tmp_path, monkeypatch):
    """A vocabulary beyond the bounds gives the same vectors, also for repeated keys, null texts and odd column names."""
    docs = spark.createDataFrame([(1, "aa bb bb", 5), (1, "cc", 6), (1, None, 7), (2, "unknown", 8), (2, "aa bb bb", 5)], "doc_id int, processed string, `a.b` int")
    for method in ("bow", "tfidf"):
        inside = vectors.fit_bag(docs, ANY, method)
        monkeypatch.setattr("lexispark.operators.scale.MAX_BROADCAST_ROWS", 1)
        beyond = vectors.fit_bag(docs, ANY, method)
        assert inside.vocabulary.small and not beyond.vocabulary.small
        made = beyond.transform(docs)
        assert made.columns == inside.transform(docs).columns
        rounded = lambda df: sorted((r["a.b"], r["doc_id"], r["features"].size, str([(int(i), round(float(v), 9)) for i, v in zip(r["features"].indices, r["features"].values)])) for r in df.collect())
        assert rounded(made) == rounded(inside.transform(docs))
        assert ranking.cosine_topk(docs, beyond, 2, 5).count() == 3
        with pytest.raises(ValueError):
            beyond.stages
        monkeypatch.undo()
