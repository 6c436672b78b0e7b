"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  data folder        (default /root/testdata/sf0.1)
    BENCH_CPUS    local threads      (default 8)
    BENCH_QUERIES comma list         (default: the headline queries)

Each query runs once untimed, then `BENCH_REPEATS` times (default 3); its time
is the median.  Results go to Spark's no-op sink, so that every row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridemill.session import build_session  # noqa: E402
from ridemill.workload import queries  # noqa: E402

HEADLINE = (
    "daily_ridership",
    "daily_ridership_minutes",
    "weekly_top_routes",
    "top_routes_last_week",
    "trip_outliers_run",
    "trip_outliers_dates",
    "trip_outliers_day",
    "normalize_trips",
    "classify_reasons",
    "quarantine_by_reason",
    "clean_trips",
    "dedupe_batch",
    "latest_per_trip",
    "merge_strict",
    "merge_open",
    "merge_small_batch",
    "replace_date_range",
    "from_csv_corrupt",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(
        "ridemill-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    times = {}
    for name in chosen:
        measured = []
        for _ in range(repeats + 1):
            begin = time.perf_counter()
            known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            measured.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(measured[1:] or measured), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
