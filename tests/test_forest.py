"""The forest over sparse rows against plain loops, and next to Spark ML's."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.linalg import Vectors

from lexispark.operators import forest, models

SIZE = 40


@pytest.fixture(scope="module")
def rows():
    """Sparse rows; two features and their values decide the class. Some have no cell, some a negative value."""
    rng = np.random.default_rng(1)
    found = []
    for i in range(900):
        idx = np.sort(rng.choice(SIZE, rng.integers(0, 12), replace=False))
        value = np.round(rng.normal(0.6, 0.5, len(idx)), 2)
        held = dict(zip(idx.tolist(), value.tolist()))
        label = int(held.get(3, 0) + held.get(7, 0) > 0.5) if i % 15 else i % 2
        found.append((label, held))
    return found


@pytest.fixture(scope="module")
def train(spark, rows):
    return spark.createDataFrame([(label, Vectors.sparse(SIZE, held)) for label, held in rows], ["label", "features"]).repartition(5).cache()


def dense(rows):
    return np.array([[held.get(f, 0.0) for f in range(SIZE)] for _, held in rows]), np.array([label for label, _ in rows])


def gini(y, weight):
    n = weight.sum()
    return 1 - sum((weight[y == c].sum() / n) ** 2 for c in (0, 1)) if n else 0.0


def test_bins_and_best_split_as_in_plain_loops(spark, train, rows):
    x, y = dense(rows)
    bins = forest.feature_bins(forest._stored(train, "features"), SIZE, 7)
    assert bins.size.max() == 7 and all((np.diff(bins.thresholds[bins.start[f] : bins.start[f + 1]]) > 0).all() for f in range(SIZE))
    code = np.array([bins.of(np.arange(SIZE), row) for row in x])
    assert all(code[r, f] == (bins.thresholds[bins.start[f] : bins.start[f + 1]] < x[r, f]).sum() for r in range(0, 900, 50) for f in range(SIZE))
    weight = np.random.default_rng(2).poisson(1.0, len(y))
    node = (x[:, 0] > 0).astype(int)  # two nodes
    drawn = np.array([[7, 3, 20, 1], [5, 9, 3, 0]])
    keys, counts = [], []
    for r in range(len(y)):
        for place, f in enumerate(drawn[node[r]]):
            if x[r, f] != 0 and weight[r]:
                keys.append(((node[r] * 4 + place) * 8 + code[r, f]) * 2 + y[r])
                counts.append(weight[r])
    total = np.array([[weight[(node == k) & (y == c)].sum() for c in (0, 1)] for k in (0, 1)])
    opened = forest.Open(np.array([0, 1]), drawn, *[np.zeros(2, int)] * 3)
    feature, split, gain, left = forest.best_splits(opened, *forest._summed(np.array(keys), np.array(counts)), total, bins.zero, bins.size, 8, 3)
    for k in (0, 1):
        own = node == k
        best = []
        for f in drawn[k]:
            for s in range(bins.size[f]):
                low = own & (code[:, f] <= s)
                high = own & ~low
                a, b = weight[low].sum(), weight[high].sum()
                if min(a, b) >= 3:
                    best.append((gini(y[own], weight[own]) - (a * gini(y[low], weight[low]) + b * gini(y[high], weight[high])) / (a + b), f, s))
        assert gain[k] == pytest.approx(max(best)[0])
        low = own & (code[:, feature[k]] <= split[k])
        assert left[k].tolist() == [weight[low & (y == c)].sum() for c in (0, 1)]


def test_beyond_the_dense_size_the_forest_is_as_good_and_splits_add_up(train, monkeypatch, tmp_path):
    settings = {"n_estimators": 30, "max_depth": 8, "min_samples_split": 4}
    plain = models.fit_forest(train, **settings)
    monkeypatch.setattr(models, "DENSE_BYTES", 0)
    made = models.fit_forest(train, **settings)
    assert isinstance(made, RandomForestClassificationModel) and made.getNumTrees == 30 and made.numFeatures == SIZE and made.numClasses == 2
    assert max(tree.depth for tree in made.trees) == 8
    right = [m.transform(train).where("prediction = label").count() / 900 for m in (plain, made)]
    assert right[1] > 0.85 and abs(right[0] - right[1]) < 0.04
    assert {*np.argsort(-made.featureImportances.toArray())[:2].tolist()} == {3, 7}
    monkeypatch.setattr(forest, "PASS_NODES", 2)  # a few nodes in each pass
    parts = models.fit_forest(train, n_estimators=3, max_depth=2)
    assert [t.numNodes > 3 for t in parts.trees] == [True] * 3
    made.write().overwrite().save(f"{tmp_path}/forest")
    assert RandomForestClassificationModel.load(f"{tmp_path}/forest").toDebugString == made.toDebugString


def test_children_hold_the_rows_of_their_parent(train):
    grown, _ = forest.grow(train, 900, SIZE, 2, 4, 5, 1, 7, "label", "features")
    for tree in grown:
        for node, left in enumerate(tree.left):
            if left >= 0:
                assert (tree.total[left] + tree.total[left + 1]).tolist() == tree.total[node].tolist()
                assert tree.total[left].sum() >= 1 and tree.total[left + 1].sum() >= 1 and tree.gain[node] > 0
        assert 700 < tree.total[0].sum() < 1100 and max(tree.level) <= 5


@pytest.mark.parametrize("label", [None, 0.5, -1.0])
def test_labels_that_are_no_class(spark, monkeypatch, label):
    monkeypatch.setattr(models, "DENSE_BYTES", 0)
    df = spark.createDataFrame([(1.0, Vectors.dense([1.0])), (label, Vectors.dense([2.0]))], ["label", "features"])
    with pytest.raises(ValueError):
        models.fit_forest(df)
