"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run once to warm up, then ``BENCH_REPEAT`` times (default 3);
the median wall time is reported.  A run executes the whole plan into the
``noop`` sink (nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "partner_daily", "silver_events", "dedup_latest", "quality_completeness", "schema_violations",
    "ref_check", "sessionize", "user_day", "user_journey", "partner_hourly", "partner_weekly",
    "dashboard_kpis", "dau_trend", "retention_curve", "events_in_session", "freshness",
    "upsert_rollup", "erase_subjects", "backfill", "run_history", "stream_rollup", "product_flow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = os.environ.get("BENCH_QUERIES")

    from lakeward.catalog import QUERIES
    from lakeward.session import build_session

    spark = build_session(f"local[{cpus}]", max(2 * cpus, 8), app="lakeward-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    selected = names.split(",") if names else (list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE)
    times, rows = {}, {}
    for name in selected:
        fn = QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()      # warm-up
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = Path(sf_dir).name.replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat}
    if "product_flow" in times:
        # comparable with the reference's demo figure: the three products end
        # to end (land, silver, quarantine, gold rollup, journey) on one input
        out["end_to_end_sec"] = times["product_flow"]
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
