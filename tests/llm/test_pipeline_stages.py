"""Stages of the corpus pipeline on rows that repeat, lack an id or have odd column names."""

from collections import Counter

import corpus_pipeline

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, `a.b` int, _row int, component_id int, first int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3, 4) for i, t in rows], COLUMNS)


def similar(a, b):
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    x, y = shingles(a), shingles(b)
    return bool(x and y) and 100 * len(x & y) >= 80 * len(x | y)


def brute_kept(rows):
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if similar(rows[i][1], rows[j][1]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = {}
    for at, (i, _) in enumerate(rows):
        key = (i is None, i or 0, at)
        best[group[at]] = min(best.get(group[at], key), key)
    return Counter(rows[key[2]] for key in best.values())


def test_one_row_of_each_group_stays(spark):
    words = [f"w{i}" for i in range(60)]
    t, k = " ".join(words), "k " * 30
    near = " ".join(words[:30] + ["changed"] + words[31:])
    far = " ".join(words[:30])
    rows = [(5, t), (1, t), (5, "u " * 9 + "v"), (7, k), (7, k), (None, t), (None, "n o p"), (None, "n o p"), (2, near), (3, far), (8, None), (8, None), (9, ""), (9, " "), (10, t.upper())]
    rows += [(100 + i, "hot copies of one text that fill the table") for i in range(40)]
    got = corpus_pipeline.near_duplicates(spark, frame(spark, rows).coalesce(1), "")
    assert got.columns == frame(spark, rows).columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == brute_kept(rows)
    assert corpus_pipeline.near_duplicates(spark, frame(spark, rows).limit(0), "").collect() == []


def test_secrets_stay_out_and_all_rows_stay(spark):
    rows = [(1, "password = hunter2hunter2 and more"), (1, "password = hunter2hunter2 and more"), (None, None), (2, "clean text"), (3, "")]
    got = corpus_pipeline.secret_scan(spark, frame(spark, rows), "").collect()
    assert len(got) == len(rows) and all("hunter2" not in (r["text"] or "") for r in got)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in got)
    assert [r["text"] for r in got if r["doc_id"] == 2] == ["clean text"]
