"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1), local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected on the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import get_spark, scratch_scope  # noqa: E402

HEADLINE = [
    "fct_daily_metrics", "int_cleaned", "silver_job", "daily_rollup", "dimension_rollup",
    "revenue_kpis", "customer_kpis", "validate_transactions", "dq_report", "schema_violations",
    "dedup_exact_first", "dedup_window", "dedup_fuzzy", "change_detection", "customer_360",
    "window_pairs", "profile_columns", "silver_contacts", "stream_daily",
    "outliers_iqr", "column_quartiles", "report_sections", "trend", "fuzzy_pairs", "stream_dedup", "bronze_to_gold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", int(cpus))
    # untimed JVM/JIT warm-up on the smallest scale factor
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        QUERIES["fct_daily_metrics"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        with scratch_scope(spark):  # what the query stored goes after its result is read
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
