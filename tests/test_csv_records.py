"""CSV records across lines and splits against the reader that takes a whole file in one task."""

import csv
import random

import pytest

from lexispark.sources import text_tables


def written(path, rows, newline="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=newline)
        writer.writerow(["Id", "Text", "Score"])
        writer.writerows(rows)


def one_task(spark, path):
    names = "Id string, Text string, Score int"
    return spark.read.options(header=True, multiLine=True, escape='"').schema(names).csv(path).select("Text", "Score")


def text(rng):
    words = ["plain", "comma, inside", 'say "hi"', "line\nbreak", "two\n\nbreaks", "ü", '"', "\n", " x "]
    return " ".join(rng.choice(words) for _ in range(rng.randrange(1, 8)))


@pytest.mark.parametrize("split", [70, 400, 10_000_000])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_of_many_splits(spark, tmp_path, rows, split, newline):
    rng = random.Random(split)
    data = [(i, text(rng), rng.randrange(1, 6)) for i in range(120)]
    data += [(200, "a field\n" * 120 + "longer than several splits", 5), (201, "", 3), (202, "last", "")]
    (tmp_path / "in").mkdir()
    written(tmp_path / "in/a.csv", data, newline)
    written(tmp_path / "in/b.csv", data[50:90], newline)
    written(tmp_path / "in/only_header.csv", [], newline)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = rows(text_tables.read_reviews(spark, str(tmp_path / "in")))
        splits = spark.read.text(str(tmp_path / "in")).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == rows(one_task(spark, str(tmp_path / "in"))) and len(got) == 163
    assert splits > 10 or split > 400
