"""Hard negatives, source mixing and the Merkle manifest against brute force, on nulls, ties, repeated rows and empty tables."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexispark.llm import merkle, mixing, negatives

VECTORS = "vec_id bigint, embedding array<double>, label int, rank int, score string, grp int"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, place int, `a.b` int, digest string, node int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, s, n, "x", 1, 2, "y", 3) for i, t, g, s, n in rows], DOCS)


def brute_negatives(rows, positives=5, negatives_=3):
    known = {}
    for i, v, g in rows:
        if i is not None and g is not None and v is not None and None not in v and np.isfinite(v).all():
            known[i] = min(known.get(i, (g, v)), (g, v))
    code = {i: [int(np.floor(256 * x)) for x in v] for i, (_, v) in known.items()}
    most = 2**63 - 1
    want = []
    for a in known:
        if a % 4:
            continue
        score = {b: max(-most, min(most, sum(x * y for x, y in zip(code[a], code[b])))) for b in known if b != a and len(code[a]) == len(code[b])}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if known[b][0] == known[a][0]][:positives]:
            inside = [b for b in order if known[b][0] != known[a][0] and 50 * score[p] <= 100 * score[b] and 100 * score[b] <= 95 * score[p]]
            want += [(a, p, r, b, score[p], score[b]) for r, b in enumerate(inside[:negatives_], 1)]
    return sorted(want)


@pytest.mark.parametrize("dim", [1, 3, 12])
def test_hard_negatives(spark, dim, monkeypatch):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(3, dim))
    rows = [(i, (base[i % 3] + rng.normal(size=dim) * 0.5).tolist(), i % 4) for i in range(160)]
    rows += [(i, rows[5][1], i % 3) for i in range(160, 220)]  # a third are copies
    rows += [(220, None, 1), (224, [None] * dim, 1), (228, [float("nan")] * dim, 1), (232, rows[0][1], None), (None, rows[0][1], 1), (5, rows[5][1], 1), (240, [0.0] * dim, 1)]
    rows += [(244, [1.0] * (dim + 1), 1), (248, [1e17] * dim, 2), (249, [1e17] * dim, 2), (250, [0.9e17] * dim, 3), (252, [], 1), (253, [], 1)]
    df = spark.createDataFrame([(i, v, g, 1, "x", 2) for i, v, g in rows], VECTORS)
    monkeypatch.setattr(negatives, "LEAST_PART", 40)  # so that small tables have several parts

    def found(df):
        made = negatives.hard_negatives(df, F.col("vec_id") % 4 == 0, F.col("label"))
        return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in made.collect())

    assert found(df) == brute_negatives(rows)
    assert found(df.limit(0)) == []


def test_bounds_hold_for_every_segment_level():
    rng = np.random.default_rng(1)
    x = negatives.Rows(np.arange(50), np.zeros(50), np.floor(rng.normal(size=(50, 37)) * 256))
    exact = x.codes @ x.codes.T
    for mean, deviation in x.levels:
        middle, around = mean @ mean.T, deviation @ deviation.T + 1e-6
        assert (middle - around <= exact).all() and (exact <= middle + around).all()
    assert len(x.levels) == 4


def highest_quotients(weights, n):
    quotients = sorted(((-w / (2 * k - 1), i, k) for i, w in enumerate(weights) if w > 0 for k in range(1, n + 1)))
    won = Counter(i for _, i, _ in quotients[:n])
    return [won[i] for i in range(len(weights))]


@pytest.mark.parametrize("weights, n", [([3.0, 1.0, 2.0], 7), ([5.0, 5.0, 5.0], 4), ([1000.0, 1.0, 1.0, 1.0], 500), ([0.0, 2.0], 3), ([1.0] * 9, 2), ([7.5, 0.1], 0)])
def test_seats_are_those_of_the_highest_quotients(spark, weights, n):
    claims = spark.createDataFrame([("g", i, w, n) for i, w in enumerate(weights)] + [("h", 0, 4.0, 5), ("h", 1, 6.0, 5)], "g string, i int, w double, seats bigint")
    got = {(r["g"], r["i"]): r["quota"] for r in mixing.seats(claims, ("g",), "w", [F.col("i")], "seats").collect()}
    want = {("g", i): q for i, q in enumerate(highest_quotients(weights, n))} | {("h", 0): 2, ("h", 1): 3}
    assert got == want
    alone = mixing.seats(claims.where("g = 'g'"), (), "w", [F.col("i")], "seats").collect()
    assert {r["i"]: r["quota"] for r in alone} == {i: q for (g, i), q in want.items() if g == "g"}


def filled(sizes, weights, total):
    """Targets by resharing what is above a cap, step by step."""
    target, free = dict.fromkeys(sizes, 0.0), set(sizes)
    left = total
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
        free -= over
        left = total - sum(target[s] for s in sizes if s not in free)
    return target


def test_mix(spark):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(1, 90)), "en", s, 1) for i in range(400) for s in [["b", "a", "é", None, "a"][i % 5]]]
    rows += [(1000, "hot " * 200, "en", "a", 1)] * 30 + [(None, "x y", "en", "b", 1)] * 40  # repeated rows
    rows += [(1001, "long " * 5000, "en", "c", 1), (2**60 + 1, "big id", "en", "b", 1), (1002, None, "en", "c", 1), (1003, " \n", None, None, None), (1004, "", "en", "only blank", 1)]
    size = F.regexp_count("text", F.lit(r"\S+"))
    got = mixing.mix(docs(spark, rows), size, shard_tokens=4000).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((i, s, len((t or "").split())) for i, t, _, s, _ in rows)
    sizes = Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = filled(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    taken = Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 64 + 0.01 * want[s]
    again = mixing.mix(docs(spark, rows).repartition(7), size, shard_tokens=4000)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, got))
    other = mixing.mix(docs(spark, rows), size, seed=1, shard_tokens=4000)
    assert Counter(map(tuple, other.collect())) != Counter(map(tuple, got))
    assert mixing.mix(docs(spark, rows).limit(0), size).collect() == []
    assert [r["taken"] for r in mixing.mix(docs(spark, [(1, None, "", "s", 1), (2, "", "", "t", 1)]), size).collect()] == [0, 0]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def reduced(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def siblings(levels, at):
    found = []
    for nodes in levels[:-1]:
        first = at - at % 3
        found.append((nodes[first:at], nodes[at + 1 : first + 3]))
        at //= 3
    return found


def brute_audit(rows):
    leaves = [(i, s, sha(*map(framed, (i, s, g, n, t))), sha(*map(framed, (i, s, g, n, t if t is None or i is None or zlib.crc32(str(i).encode()) % 2 else t.replace("\n", ""))))) for i, t, g, s, n in rows]
    groups = {}
    for leaf in sorted(leaves, key=lambda x: (x[0] is not None, x[0] or 0, x[2])):
        groups.setdefault(leaf[1], []).append(leaf)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: reduced([x[2] for x in groups[s]]) for s in order}
    top = reduced([trees[s][-1][0] for s in order])
    want = []
    for place, s in enumerate(order):
        for at, (i, _, leaf, after) in enumerate(groups[s]):
            path = siblings(trees[s], at) + siblings(top, place)
            now = after
            for left, right in path:
                now = sha(*left, now, *right)
            want.append((i, leaf, trees[s][-1][0], top[-1][0], sha(*[x for left, right in path for x in left + right]), now, now == top[-1][0]))
    return Counter(want)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_merkle_audit(spark, levels):
    rows = [(i * 7 % 101, f"text {i}\nmore\n" if i % 3 else "ü*/", "en", ["a", None, "é", "b"][min(i % 9, 3)], i) for i in range(101)]
    rows += [(500, "one", "en", "single", 3), (501, None, None, "", None), (None, "no id\n", "en", "a", 1), (2**60 + 1, "big\n", "en", "a", 1), (None, "no id\n", "en", "a", 1)]
    rows += [(600, "same\n", "en", "copies", 5)] * 30 + [(601, "long " * 5000, "en", "copies", 5)]
    for part in (rows, rows[:1], [(1, "a\n", "x", "s", 1), (2, "b\n", "x", "t", 1)], [(1, "a", "x", "s", 1), (1, "b", "x", "s", 1)]):
        got = Counter(map(tuple, merkle.audit(docs(spark, part).repartition(3), levels=levels).collect()))
        assert got == brute_audit(part)
    assert merkle.audit(docs(spark, rows).limit(0), levels=levels).collect() == []
