"""Headline benchmark: one JSON line with the seconds of each query.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
All queries run once to warm up, then each three times; the median counts. Results go to the
no-op sink, so every row and column is computed and nothing passes through the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from amendry.queries import REGISTRY
from amendry.session import local_session

HEADLINE = [
    "job_backfill_history",
    "job_backfill_priority",
    "job_split_net_tax",
    "job_find_anomalies",
    "job_correct_decisions",
    "job_open_letters",
    "job_sync_salary",
    "job_premium_report",
    "lookup_checked",
    "rate_asof",
    "latest_batch",
    "list_agg_fixed",
    "pivot_exclusions",
    "update_keyed",
    "join_threeway",
    "join_anti",
    "check_pk",
    "limit_n",
    "sort_multi",
    "log_by_day",
]


def seconds(spark, build, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        seconds(spark, REGISTRY[name], sf_dir)
    for name in HEADLINE:
        build = REGISTRY[name]
        timings[name] = round(statistics.median(seconds(spark, build, sf_dir) for _ in range(3)), 3)
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
