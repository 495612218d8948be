"""Time headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores. Every query runs
whole, into a sink that discards rows: once to warm up, then BENCH_RUNS times
for the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from feedback_engine import catalog
from feedback_engine.session import build_session

QUERIES = (
    "clean_text",
    "preprocess_text",
    "dedup_reviews",
    "filter_pipeline",
    "full_report",
    "batch_stats",
    "lookup_user_id",
    "upsert_reviews",
    "langid_train",
    "langid_score",
    "classify_source",
    "sink_reviews",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in QUERIES:
        timings = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalog.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(timings[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
