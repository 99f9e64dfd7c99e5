"""Bench: run the headline reports and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (repeated runs per query, default 5).
Each run builds the plan and executes it whole into Spark's ``noop`` sink (no
collect to the driver). ``first`` is the first run of each query in the session,
as a scheduled job pays it; ``queries`` is the median of the repeated runs, and
``value`` the sum of those medians.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortline.plans.catalog import QUERIES  # noqa: E402
from cohortline.session import local_session  # noqa: E402

HEADLINE = (
    "report_policy_orders",            # R1 daily refresh (8-day window)
    "policy_orders_backfill",          # R2 backfill (all hits)
    "replace_window",                  # U23 on top of R2
    "report_purchases_default",        # R3
    "report_purchases_custom",         # R4
    "report_reconcile",                # R5
    "report_retention_monthly",        # R6
    "report_retention_weekly",         # R7
    "report_retention_monthly_manual", # R8
    "report_dashboard",                # R9
)


def run_once(spark, key, sf_dir) -> float:
    t0 = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cores=cpus, shuffle_partitions=max(int(cpus) * 2, 8) if cpus.isdigit() else 16,
                          app_name="cohortline-bench")
    times, first = {}, {}
    for key in HEADLINE:
        first[key] = round(run_once(spark, key, sf_dir), 3)
        times[key] = round(statistics.median(run_once(spark, key, sf_dir) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "report_suite_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first": first,
        "first_value": round(sum(first.values()), 3),
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
