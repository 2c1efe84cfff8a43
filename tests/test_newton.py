"""The squared-hinge machine against a plain solver, and token replacement on both paths."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors

from lexispark.config import review_config
from lexispark.operators import models, newton, normalize


def plain_solver(x, y, C):
    """Newton steps with the whole Hessian and halved steps, to a gradient of 1e-10."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    value = lambda w: 0.5 * w @ w + C * (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    for _ in range(200):
        short = np.maximum(0, 1 - y * (x @ w))
        gradient = w - 2 * C * x.T @ (y * short)
        if np.linalg.norm(gradient) < 1e-10:
            break
        active = x[short > 0]
        step = np.linalg.solve(np.eye(len(w)) + 2 * C * active.T @ active, -gradient)
        size = 1.0
        while size > 1e-8 and value(w + size * step) > value(w):
            size /= 2
        w = w + size * step
    return w


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 12)) * (rng.random((300, 12)) < 0.4)
    x[7] = 0
    y = np.where(x @ rng.normal(size=12) + 0.7 * rng.normal(size=300) + 0.4 > 0, 1.0, -1.0)
    return x, y


@pytest.mark.parametrize("C", [0.1, 1.0, 50.0])
def test_weights_are_those_of_a_plain_solver(spark, rows, C):
    x, y = rows
    sparse = [(int(b > 0), Vectors.sparse(12, [(i, v) for i, v in enumerate(a) if v])) for a, b in zip(x.tolist(), y)]
    mixed = sparse[:200] + [(int(b > 0), Vectors.dense(a)) for a, b in zip(x[200:].tolist(), y[200:])]
    want = plain_solver(x, y, C)
    for data in (sparse, mixed):
        model = models.fit_svm(spark.createDataFrame(data, ["label", "features"]).repartition(5), C=C)
        got = np.append(model.coefficients.toArray(), model.intercept)
        assert np.abs(got - want).max() < 1e-3
    scored = model.transform(spark.createDataFrame(sparse, ["label", "features"])).collect()
    assert [r["prediction"] for r in scored] == [float(v > 0) for v in np.hstack([x, np.ones((300, 1))]) @ want]


def test_passes_over_partitions_find_the_same_weights(spark, rows, monkeypatch):
    x, y = rows
    data = [(int(b > 0), Vectors.dense(a)) for a, b in zip(x.tolist(), y)]
    monkeypatch.setattr(newton, "TASK_ROWS", 10)
    model = models.fit_svm(spark.createDataFrame(data, ["label", "features"]).repartition(3), C=0.5)
    assert np.abs(np.append(model.coefficients.toArray(), model.intercept) - plain_solver(x, y, 0.5)).max() < 1e-3


def test_partial_sums_are_added_in_a_tree(spark, rows, monkeypatch):
    x, y = rows
    data = [(int(b > 0), Vectors.dense(a)) for a, b in zip(x.tolist(), y)]
    df = spark.createDataFrame(data, ["label", "features"]).repartition(9)
    monkeypatch.setattr(newton, "DIRECT", 2)
    objective = newton.SquaredHinge(newton.blocks(df, "label", "features"), 13, 1.0)
    w = np.linspace(-1, 1, 13)
    full = np.hstack([x, np.ones((300, 1))])
    short = np.maximum(0, 1 - y * (full @ w))
    value, gradient = objective.at(w)
    assert value == pytest.approx(0.5 * w @ w + short @ short) and gradient == pytest.approx(w - 2 * full.T @ (y * short))
    active = full[short > 0]
    assert objective.bent(w, gradient) == pytest.approx(gradient + 2 * active.T @ (active @ gradient))


def test_no_rows_and_one_class(spark):
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 0.0])), (1, Vectors.dense([0.0, 1.0]))], ["label", "features"])
    with pytest.raises(ValueError):
        models.fit_svm(df.limit(0))
    want = plain_solver(np.eye(2), np.ones(2), 1.0)
    model = models.fit_svm(df)
    assert np.append(model.coefficients.toArray(), model.intercept) == pytest.approx(want, abs=1e-3)


def test_terms_are_replaced_alike_on_both_paths(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i % 7, [f"w{rng.randrange(30)}" for _ in range(rng.randrange(9))]) for i in range(60)] + [(3, None), (4, []), (5, ["w1", "", "w1"])]
    df = spark.createDataFrame(rows, "doc_id int, tokens array<string>").repartition(3)
    mapping = spark.createDataFrame([(f"w{i}", f"w{i // 2}" if i % 3 else f"w{i}") for i in range(30)], "term string, new_term string")
    table = dict(map(tuple, mapping.collect()))
    want = sorted((i, [table.get(t, t) for t in tokens or []]) for i, tokens in rows)

    def found(mapping):
        return sorted((r[0], r[1]) for r in normalize.replace_terms(df, "tokens", mapping, ["doc_id"]).collect())

    assert found(mapping) == want
    assert found(mapping.limit(0)) == sorted((i, t or []) for i, t in rows)
    monkeypatch.setattr("lexispark.operators.scale.MAX_BROADCAST_ROWS", 1)
    assert found(mapping) == want


def test_a_dictionary_of_several_broadcasts_is_looked_up_inside_the_row(spark, monkeypatch):
    """Neither tokens nor the other columns of a row are shuffled, and a worker lets go of one part before the next."""
    monkeypatch.setattr("lexispark.operators.scale.MAX_BROADCAST_ROWS", 7)
    texts = [" ".join(f"{'ab'[i % 2]}word{chr(97 + j)}s x{i}" for j in range(i % 24)) for i in range(120)] + [None, "  "]
    rows = [(i % 9, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    terms = {f"{x}word{chr(97 + j)}" for x in "ab" for j in range(24)}
    lexicon = spark.createDataFrame([(t,) for t in terms], "form string")
    want = sorted(" ".join(w[:-1] if w[:-1] in terms else w for w in (t or "").split()) for t in texts)
    done = normalize.process(df, "text", review_config(), lexicon=lexicon)
    steps = normalize.explain_steps(df, "text", review_config(), lexicon=lexicon)
    for found, column in ((done, "processed"), (steps, "final")):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in text and "Exchange" not in text and "Join" not in text
        assert sorted(r[column] for r in found.collect()) == want
    monkeypatch.setattr(normalize, "LOOKUP_PARTS", 2)  # too many parts for that
    again = normalize.explain_steps(df, "text", review_config(), lexicon=lexicon)
    assert again.columns == steps.columns and sorted(map(str, again.collect())) == sorted(map(str, steps.collect()))
    changed = [spark.createDataFrame([(f"a{i}", f"b{i}")], "term string, new_term string") for i in range(3)]
    parts: list = []
    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: parts.append(broadcast(self, value)) or parts[-1])
    assert normalize._looked_up(*changed).func(pa.array([["a2", "a0", "x", None], ["a1"]])).to_pylist() == [["b2", "b0", "x", None], ["b1"]]
    assert len(parts) == 3 and not any("_value" in vars(part) for part in parts)


def test_looking_terms_up_holds_no_hash_table_of_the_dictionary(spark, monkeypatch):
    changed = spark.range(1000).selectExpr("concat('term', id, 's') AS term", "concat('term', id) AS new_term")
    replaced = normalize._looked_up(changed).func
    held, index_in = [], normalize.pc.index_in
    monkeypatch.setattr(normalize.pc, "index_in", lambda values, value_set: held.append(len(value_set)) or index_in(values, value_set=value_set))
    tokens = pa.array([["term7s", None, "term7"], [], ["term999s", "term7s"]])
    assert replaced(tokens).to_pylist() == [["term7", None, "term7"], [], ["term999", "term7"]]
    assert held == [3]


def test_one_sum_reaches_the_driver(spark, rows, monkeypatch):
    """However few partitions there are."""
    x, y = rows
    df = spark.createDataFrame([(int(b > 0), Vectors.dense(a)) for a, b in zip(x.tolist(), y)], ["label", "features"]).repartition(5)
    sent = []
    collected = type(df).toArrow
    monkeypatch.setattr(type(df), "toArrow", lambda self: sent.append(collected(self)) or sent[-1])
    newton.SquaredHinge(newton.blocks(df, "label", "features"), 13, 1.0).at(np.zeros(13))
    assert [t.num_rows for t in sent] == [1]
