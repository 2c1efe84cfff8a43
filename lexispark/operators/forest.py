"""Random forest over sparse rows, for training sets whose dense points are too large for Spark ML's.

Spark ML turns every row into a dense array with one bin for each feature, and every task sends dense counts of all nodes of a
group. Here a row keeps its stored cells only. A pass over the rows counts, for the open nodes of all trees, the stored cells of
the features drawn for the node by bin and class; what is missing from the node's rows are zeros. The counts of a tree meet in one
task, which finds the best split of each of its nodes. Only splits reach the driver.

The method is that of Spark ML: Poisson bootstrap for each tree, sqrt(features) drawn for each node, quantile bins of a sample of
rows, Gini gain, leaves of equal prediction merged. Draws follow the seed and differ from Spark ML's, so the trees do too.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lexispark.operators.scale import work_dir

TASK_ROWS = 50_000
# open nodes that one pass counts: in all, and cells of the table that finds a tree's drawn features by node
PASS_NODES = 1 << 17
TABLE_CELLS = 1 << 24
_DENSE = 1 << 22  # cells of the counts that are compared at once
_KINDS = {"y": np.int32, "at": np.int64, "idx": np.int32, "bin": np.uint8}
_COUNTS = "tree int, key binary, n binary, total binary"
_SPLITS = "tree int, feature binary, split binary, gain binary, left binary, total binary"


@dataclass(frozen=True)
class Bins:
    """Thresholds of all features one after the other, where each feature's begin, and the bin of a zero."""

    thresholds: np.ndarray
    start: np.ndarray
    zero: np.ndarray

    @property
    def size(self) -> np.ndarray:
        return np.diff(self.start)

    def of(self, idx: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The bin of each cell: the number of its feature's thresholds that are below the value."""
        low, high = self.start[idx], self.start[idx + 1]
        while (low < high).any():
            mid = (low + high) // 2
            below = (low < high) & (self.thresholds[np.minimum(mid, max(0, len(self.thresholds) - 1))] < value)
            low, high = np.where(below, mid + 1, low), np.where(below, high, np.minimum(mid, high))
        return (low - self.start[idx]).astype(np.uint8)


def feature_bins(sample: DataFrame, size: int, most: int) -> Bins:
    """Up to ``most`` thresholds for each feature between values of a sample of rows ``(idx, value)``, zeros included, as Spark ML sets them."""
    table = sample.toArrow().combine_chunks()
    rows = table.num_rows
    idx = table["idx"].combine_chunks().flatten().to_numpy() if rows else np.zeros(0, np.int32)
    value = table["value"].combine_chunks().flatten().to_numpy() if rows else np.zeros(0)
    idx, value = idx[value != 0], value[value != 0]
    by = np.lexsort((value, idx))
    idx, value = idx[by], value[by]
    at = np.searchsorted(idx, np.arange(size + 1))
    found = [_thresholds(*np.unique(value[at[f] : at[f + 1]], return_counts=True), rows, most) for f in range(size)]
    start = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
    zero = np.array([int(np.searchsorted(x, 0.0)) for x in found], np.int64)
    return Bins(np.concatenate([*found, np.zeros(0)]), start, zero)


def _thresholds(values: np.ndarray, counts: np.ndarray, rows: int, most: int) -> np.ndarray:
    zeros = rows - int(counts.sum())
    if zeros > 0:
        place = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, place, 0.0), np.insert(counts, place, zeros)
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = rows / (most + 1)
    total, target, chosen = np.cumsum(counts).tolist(), stride, []
    for i in range(1, len(total)):
        if abs(total[i - 1] - target) < abs(total[i] - target):
            chosen.append(i - 1)
            target += stride
    return middle[chosen[:most]]


@dataclass
class Tree:
    """Nodes in the order in which they were made: children follow their parent, the right one the left one."""

    feature: list[int] = field(default_factory=list)  # -1: none
    split: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    level: list[int] = field(default_factory=list)
    total: list[np.ndarray | None] = field(default_factory=list)

    def add(self, level: int, total: np.ndarray | None) -> int:
        for held, value in ((self.feature, -1), (self.split, 0), (self.left, -1), (self.gain, -1.0), (self.level, level), (self.total, total)):
            held.append(value)
        return len(self.feature) - 1


@dataclass(frozen=True)
class Open:
    """The open nodes of a tree in a pass: their numbers, the features drawn for each, and the tree so far."""

    nodes: np.ndarray
    drawn: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray


def _gini(counts: np.ndarray) -> np.ndarray:
    n = counts.sum(axis=-1)
    return 1.0 - (counts * counts).sum(axis=-1) / np.maximum(n * n, 1e-300) * (n > 0) - (n <= 0)


def packed_rows(train: DataFrame, bins: Bins, label: str, features: str) -> DataFrame:
    """One row for each batch of rows: classes, row starts, indices and bins of the stored cells, as bytes."""
    sent = train.sparkSession.sparkContext.broadcast(bins)
    rows = _stored(train, features, F.col(label).cast("int").alias("y"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            idx = batch.column("idx")
            length, at = np.diff(idx.offsets.to_numpy()), idx.flatten().to_numpy()
            found = {"y": batch.column("y").to_numpy(), "at": np.concatenate([[0], np.cumsum(length)]), "idx": at}
            found["bin"] = sent.value.of(at, batch.column("value").flatten().to_numpy())
            whole = [pa.array([np.asarray(found[c], kind).tobytes()], pa.binary()) for c, kind in _KINDS.items()]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), *whole], ["part", "number", *_KINDS])
            number += 1

    return rows.mapInArrow(packed, "part int, number int, " + ", ".join(f"{c} binary" for c in _KINDS))


def _stored(df: DataFrame, features: str, *more) -> DataFrame:
    stored = F.unwrap_udt(features)
    indices = F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(stored["values"]) - 1))
    return df.select(*more, indices.alias("idx"), stored["values"].alias("value"))


def _routed(tree: Open, rows: np.ndarray, key: np.ndarray, bin_: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """The node of each row. ``key`` has row times features plus feature of all cells, in order."""
    size, node = len(zero), np.zeros(len(rows), np.int64)
    on = np.flatnonzero(tree.left[node] >= 0)
    while len(on):
        here = node[on]
        feature = tree.feature[here]
        wanted = rows[on] * size + feature
        place = np.minimum(np.searchsorted(key, wanted), max(0, len(key) - 1))
        value = np.where(key[place] == wanted, bin_[place], zero[feature]) if len(key) else zero[feature]
        node[on] = tree.left[here] + (value > tree.split[here])
        on = on[tree.left[node[on]] >= 0]
    return node


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each."""
    if not len(key):
        return key, n
    by = np.argsort(key)
    key, n = key[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _counted(table: DataFrame, sent, zero: np.ndarray, bins: int, classes: int, seed: int, trees: int) -> DataFrame:
    """For each task and tree the counts by node, drawn feature, bin and class of stored cells, and by node and class of rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Open] = sent.value
        size = len(zero)
        keys: dict[int, list] = {t: [] for t in opened}
        totals = {t: np.zeros(len(o.nodes) * classes, np.int64) for t, o in opened.items()}
        for batch in batches:
            for r in range(batch.num_rows):
                part, number = (batch.column(c)[r].as_py() for c in ("part", "number"))
                y, at, idx, bin_ = (np.frombuffer(batch.column(c)[r].as_buffer(), kind) for c, kind in _KINDS.items())
                length = np.diff(at)
                row = np.repeat(np.arange(len(y)), length)
                key = row * size + idx
                drawn = np.random.default_rng([seed, part, number]).poisson(1.0, (trees, len(y))).astype(np.int64)
                for t, tree in opened.items():
                    bag = np.flatnonzero(drawn[t])
                    node = _routed(tree, bag, key, bin_, zero)
                    place = np.full(len(tree.left), -1)
                    place[tree.nodes] = np.arange(len(tree.nodes))
                    own = np.full(len(y), -1, np.int32)  # the open node of each row of the bag
                    own[bag] = place[node]
                    there = np.flatnonzero(own >= 0)
                    totals[t] += np.bincount(own[there] * classes + y[there], weights=drawn[t][there], minlength=len(totals[t])).astype(np.int64)
                    # the drawn features of each open node by their place, and last those of no node
                    where = np.full((len(tree.nodes) + 1, size), -1, np.int16)
                    np.put_along_axis(where[:-1], tree.drawn, np.arange(tree.drawn.shape[1], dtype=np.int16)[None, :], 1)
                    used = (where >= 0).any(axis=0)
                    base = np.where(own >= 0, own, len(tree.nodes)).astype(np.int32) * np.int32(size)
                    if used.mean() < 0.3:
                        cell = np.flatnonzero(used[idx])
                        drawn_at = where.ravel().take(base[row[cell]] + idx[cell])
                        hit = np.flatnonzero(drawn_at >= 0)
                        cell = cell[hit]
                    else:
                        drawn_at = where.ravel().take(np.repeat(base, length) + idx)
                        cell = hit = np.flatnonzero(drawn_at >= 0)
                    of = own[row[cell]].astype(np.int64)
                    found = ((of * tree.drawn.shape[1] + drawn_at[hit]) * bins + bin_[cell]) * classes + y[row[cell]]
                    keys[t].append(_summed(found, drawn[t][row[cell]]))
        for t, parts in keys.items():
            if parts:
                key, n = _summed(*(np.concatenate(x) for x in zip(*parts)))
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (key, n, totals[t]))], ["tree", "key", "n", "total"])

    return table.mapInArrow(counted, _COUNTS)


def best_splits(tree: Open, key: np.ndarray, n: np.ndarray, total: np.ndarray, zero: np.ndarray, splits: np.ndarray, bins: int, least: int) -> tuple[np.ndarray, ...]:
    """For each open node the feature (-1: none), bin, gain and left counts of its best split. ``total(node, class)``."""
    nodes, drawn, classes = len(tree.nodes), tree.drawn.shape[1], total.shape[1]
    feature, split, gain, left = np.full(nodes, -1), np.zeros(nodes, np.int64), np.full(nodes, -1.0), np.zeros((nodes, classes))
    width = drawn * bins * classes
    step = max(1, _DENSE // width)
    for a in range(0, nodes, step):
        b = min(nodes, a + step)
        some = slice(np.searchsorted(key, a * width), np.searchsorted(key, b * width))
        counts = np.zeros((b - a) * width)
        counts[key[some] - a * width] = n[some]
        counts = counts.reshape(b - a, drawn, bins, classes)
        whole, own = total[a:b].astype(float), tree.drawn[a:b]
        at, of = np.indices(own.shape)
        counts[at, of, zero[own]] += whole[:, None, :] - counts.sum(axis=2)
        below = counts.cumsum(axis=2)[:, :, : bins - 1]
        above = whole[:, None, None, :] - below
        lower, upper, everything = below.sum(axis=3), above.sum(axis=3), whole.sum(axis=1)[:, None, None]
        won = _gini(whole)[:, None, None] - (lower * _gini(below) + upper * _gini(above)) / np.maximum(everything, 1)
        valid = (lower >= least) & (upper >= least) & (np.arange(bins - 1) < splits[own][:, :, None])
        won = np.where(valid, won, -1.0).reshape(b - a, -1)
        best = won.argmax(axis=1)
        each = np.arange(b - a)
        gain[a:b], split[a:b] = won[each, best], best % (bins - 1)
        place = best // (bins - 1)
        left[a:b] = below[each, place, split[a:b]]
        feature[a:b] = np.where(gain[a:b] > 0, own[each, place], -1)
    return feature, split, gain, left


def _searched(parts: DataFrame, sent, bins: Bins, most: int, classes: int, least: int) -> DataFrame:
    """The best split of every open node; the counts of a tree are in one partition."""
    zero, splits = bins.zero, bins.size

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[int, Open] = sent.value
        held: dict[int, list] = {}
        for batch in batches:
            for r in range(batch.num_rows):
                held.setdefault(batch.column(0)[r].as_py(), []).append([np.frombuffer(batch.column(c)[r].as_py(), np.int64) for c in (1, 2, 3)])
        for t in sorted(held):
            key, n, total = zip(*held.pop(t))
            whole = np.sum(total, axis=0).reshape(-1, classes)
            found = best_splits(opened[t], *_summed(np.concatenate(key), np.concatenate(n)), whole, zero, splits, most, least)
            arrays = [x.astype(kind) for x, kind in zip((*found, whole), (np.int64, np.int64, float, float, float))]
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in arrays)], ["tree", "feature", "split", "gain", "left", "total"])

    return parts.mapInArrow(searched, _SPLITS)


def _draw(rng: np.random.Generator, nodes: int, size: int, drawn: int) -> np.ndarray:
    """``drawn`` different features for each node."""
    step = max(1, _DENSE // size)
    return np.concatenate([rng.random((min(step, nodes - a), size)).argpartition(drawn - 1, axis=1)[:, :drawn] for a in range(0, nodes, step)])


def grow(train: DataFrame, rows: int, size: int, classes: int, trees: int, depth: int, least: int, seed: int, label: str, features: str, max_bins: int = 32) -> tuple[list[Tree], Bins]:
    """The trees, level by level; every pass takes a bounded number of open nodes."""
    spark = train.sparkSession
    wanted = max(max_bins * max_bins, 10_000)
    sample = train.sample(min(1.0, wanted / rows), seed) if rows > wanted else train
    most = min(max_bins, rows)
    bins = feature_bins(_stored(sample, features), size, most - 1)
    cores = spark.sparkContext.defaultParallelism
    table = packed_rows(train.coalesce(max(cores, math.ceil(rows / TASK_ROWS))), bins, label, features).persist(StorageLevel.MEMORY_AND_DISK)
    drawn, rng, zero = math.ceil(math.sqrt(size)), np.random.default_rng(seed), bins.zero
    forest = [Tree() for _ in range(trees)]
    waiting = [[tree.add(0, None)] for tree in forest]
    try:
        while any(waiting):
            opened, room = {}, PASS_NODES
            for t, nodes in enumerate(waiting):
                n = min(len(nodes), room, max(1, TABLE_CELLS // size))
                if n:
                    tree = forest[t]
                    opened[t] = Open(np.array(nodes[:n]), _draw(rng, n, size, drawn), *(np.array(x) for x in (tree.feature, tree.split, tree.left)))
                    waiting[t], room = nodes[n:], room - n
            sent = spark.sparkContext.broadcast(opened)
            parts = _counted(table, sent, zero, most, classes, seed, trees)
            answers = _searched(parts.repartition(min(len(opened), 4 * cores), "tree"), sent, bins, most, classes, least).toArrow().to_pylist()
            sent.unpersist()
            for answer in answers:
                t = answer["tree"]
                feature, split = (np.frombuffer(answer[c], np.int64).tolist() for c in ("feature", "split"))
                gain = np.frombuffer(answer["gain"]).tolist()
                left, total = (np.frombuffer(answer[c]).reshape(-1, classes) for c in ("left", "total"))
                tree = forest[t]
                for i, node in enumerate(opened[t].nodes.tolist()):
                    tree.total[node] = total[i]
                    if feature[i] < 0 or tree.level[node] >= depth:
                        continue
                    tree.feature[node], tree.split[node], tree.gain[node] = feature[i], split[i], gain[i]
                    for child in (left[i], total[i] - left[i]):
                        made = tree.add(tree.level[node] + 1, child)
                        if tree.left[node] < 0:
                            tree.left[node] = made
                        if tree.level[made] < depth and np.count_nonzero(child) > 1:
                            waiting[t].append(made)
    finally:
        table.unpersist()
    return forest, bins


def _node_rows(number: int, tree: Tree, bins: Bins) -> list[dict]:
    """The nodes as Spark ML writes them; a node whose children are leaves of one prediction is a leaf itself."""
    left, predicted = list(tree.left), [int(np.argmax(x)) for x in tree.total]
    for node in reversed(range(len(left))):
        a = left[node]
        if a >= 0 and left[a] < 0 and left[a + 1] < 0 and predicted[a] == predicted[a + 1]:
            left[node] = -1
    kept, place = [0], {0: 0}
    for node in kept:  # grows while it is read
        if left[node] >= 0:
            for child in (left[node], left[node] + 1):
                place[child] = len(kept)
                kept.append(child)
    rows = []
    for node in kept:
        total, inner = tree.total[node], left[node] >= 0
        split = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        if inner:
            at = bins.start[tree.feature[node]] + tree.split[node]
            split = {"featureIndex": tree.feature[node], "leftCategoriesOrThreshold": [float(bins.thresholds[at])], "numCategories": -1}
        data = {"id": place[node], "prediction": float(predicted[node]), "impurity": float(_gini(total)), "impurityStats": total.tolist(), "rawCount": int(total.sum()), "gain": tree.gain[node] if inner else -1.0}
        data |= {"leftChild": place[left[node]] if inner else -1, "rightChild": place[left[node] + 1] if inner else -1, "split": split}
        rows.append({"treeID": number, "nodeData": data})
    return rows


_SPLIT_TYPE = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE_TYPE = pa.struct(
    [("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64())]
    + [("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT_TYPE)]
)


def _described(spark, estimator, path: str, **more) -> str:
    """The metadata of the model of an estimator, which Spark has no public way to make."""
    estimator.write().overwrite().save(path)
    found = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return json.dumps(found | {"class": found["class"].replace("Classifier", "ClassificationModel"), **more})


def fit_sparse_forest(train: DataFrame, estimator: RandomForestClassifier, rows: int, size: int) -> RandomForestClassificationModel:
    """The model of an estimator over sparse rows, written in Spark ML's format and loaded from there."""
    spark, label, features = train.sparkSession, estimator.getLabelCol(), estimator.getFeaturesCol()
    missing, lowest, highest, broken = train.agg(F.count_if(F.col(label).isNull()), F.min(label), F.max(label), F.count_if(F.col(label) != F.floor(label))).first()
    if missing or broken or lowest < 0:
        raise ValueError("Labels are whole numbers from 0")
    classes = int(highest) + 1
    trees, depth, least, seed = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), estimator.getSeed()
    forest, bins = grow(train, rows, size, max(2, classes), trees, depth, least, abs(seed), label, features, estimator.getMaxBins())
    path = f"{work_dir(spark)}/lexispark/forest-{uuid.uuid4().hex}"
    numbers = {"numFeatures": size, "numClasses": max(2, classes)}
    whole = _described(spark, estimator, f"{path}/estimator", **numbers, numTrees=trees)
    one = DecisionTreeClassifier(labelCol=label, featuresCol=features, maxDepth=depth, minInstancesPerNode=least, seed=seed)
    single = _described(spark, one, f"{path}/tree", **numbers)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    spark.createDataFrame([(t, single, 1.0) for t in range(trees)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    nodes = [row for t, tree in enumerate(forest) for row in _node_rows(t, tree, bins)]
    table = pa.table({"treeID": pa.array([n["treeID"] for n in nodes], pa.int32()), "nodeData": pa.array([n["nodeData"] for n in nodes], _NODE_TYPE)})
    spark.createDataFrame(table).write.parquet(f"{path}/model/data")
    return RandomForestClassificationModel.load(f"{path}/model")
