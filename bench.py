"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402

HEADLINES = (
    "t13_review_preset",
    "k09_process",
    "k10_process_batch",
    "a05_top_tokens",
    "p10_stratified_split",
    "v07_feature_names",
    "v11_tfidf_transform",
    "v16_top_terms",
    "r01_bm25_statistics",
    "r03_bm25_rank",
    "r07_cosine_tfidf",
    "e10_evaluate_all",
    "m07_fit_all",
    "m08_predict_all",
    "e17_train_and_record",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(cpus)
    from checks.catalog import QUERIES

    spark.read.parquet(f"{folder}/labels.parquet").count()  # start the JVM's readers before the clock
    seconds = {}
    for name in HEADLINES:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
