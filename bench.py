"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads,
``BENCH_RUNS`` the timed runs after one warm-up (the median counts). A query
whose warm-up takes more than ``LONG`` seconds is timed once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from webfacts.plans import queries

LONG = 30
HEADLINE = [
    "page_sentences", "clean_sentences", "entities_flat", "entity_arrays", "marked_pairs",
    "label_containment", "kb_candidates", "entity_links", "connecting_paths", "tfidf_words",
    "result_lines", "score_entities", "feature_paths", "tfidf_bigrams", "svm_predictions", "page_facts",
]


def timed(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("webfacts-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    seconds = {}
    for name in names:
        query = getattr(queries, name)
        times = 1 if timed(query, spark, sf_dir) > LONG else runs
        seconds[name] = round(statistics.median(timed(query, spark, sf_dir) for _ in range(times)), 3)
    print(json.dumps({
        "metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
