"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder with the tables; BENCH_CPUS: local cores; BENCH_RUNS: timed runs per query
(the median counts, after one warm-up run). Names on the command line choose queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from pressroom.plans.queries import all_queries

HEADLINE = [
    "quality_report", "curated_text", "best_text", "text_measure", "spam_score", "extract_text",
    "boilerplate_blocks", "url_left_join", "fetch_progress", "metadata_rows", "new_rows_anti",
    "status_advance", "upsert", "upsert_metrics", "stored_upsert", "sentences",
    "sentence_weights", "dense_centrality", "tfidf_centrality", "summary", "batch_requests",
    "parse_responses", "price_refresh", "news_flow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pressroom-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
