"""Times the headline queries; prints one JSON line.

Each batch query runs once to warm up and then three times, the median counts. Streaming queries
replay their input from disk and run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from townads.plans.catalog import QUERIES
from townads.session import build_session

BATCH = [
    "tumbling_city_year_count",
    "sliding_city_count",
    "sliding_city_count_panes",
    "sliding_city_count_sql",
    "sliding_uneven_count",
    "session_city_count",
    "topk_cities",
    "tumbling_posted_date",
    "count_by_city",
    "distinct_city_ad",
    "pass_through",
    "filter_null_cities",
    "decode_json",
    "quarantine_bad_records",
    "encode_json",
    "read_result_topics",
    "sum_over_time_city",
    "sum_over_time_year",
    "last_over_time_city",
    "cumulative_city",
    "recent_range",
    "extract_ads",
    "extract_links",
    "link_frontier",
    "count_changelog",
]
STREAMS = ["stream_tumbling", "stream_sliding", "stream_changelog"]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("OFF")
    only = sys.argv[1:]
    for _ in range(2):
        run(spark, BATCH[0], sf_dir)
    timings = {}
    for name in BATCH + STREAMS:
        if only and name not in only:
            continue
        if name in STREAMS:
            timings[name] = run(spark, name, sf_dir)
        else:
            run(spark, name, sf_dir)
            timings[name] = statistics.median(run(spark, name, sf_dir) for _ in range(3))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(sec, 3) for name, sec in timings.items()},
                "sf": os.path.basename(os.path.normpath(sf_dir)),
            }
        )
    )


if __name__ == "__main__":
    main()
