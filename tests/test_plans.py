"""The shape of the plans: scans, shuffles, pushed filters."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ridemill.operators import (
    classify_trips,
    daily_ridership,
    merge_trips,
    route_duration_stats,
    sized,
    top_routes_last_week,
    trip_outliers,
    weekly_top_routes,
)
from ridemill.operators.metrics import observe_fingerprints
from ridemill.operators.outliers import run_scope
from tests.helpers import AS_OF, ENRICHED, RAW, SILVER, plan_of, ride

DAYS = ("2025-01-10", "2025-01-12")


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    rows = [ride(f"T{i}", f"R{i % 5}", f"2025-01-{10 + i % 3} 0{i % 9}:00:00", i % 40) for i in range(90)]
    path = str(tmp_path_factory.mktemp("trips"))
    spark.createDataFrame(rows, ENRICHED).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scans(plan):
    return plan.count("FileScan parquet")


def shuffles(plan):
    return plan.count("Exchange hashpartitioning")


def test_daily_reads_once_and_shuffles_twice(trips):
    plan = plan_of(daily_ridership(trips, *DAYS))
    assert (scans(plan), shuffles(plan)) == (1, 2)
    assert "SortAggregate" not in plan and "Window" not in plan and "Join" not in plan
    assert "GreaterThanOrEqual(start_time" in plan and "LessThan(start_time" in plan
    assert "distance_km" not in plan and "sfn_execution_id" not in plan


def test_weekly_sums_before_it_copies(trips):
    plan = plan_of(weekly_top_routes(trips, *DAYS))
    assert scans(plan) == 1 and "Join" not in plan
    copies = plan.index("Generate explode")
    assert "HashAggregate" in plan[copies:] and plan.count("WindowGroupLimit") == 2
    assert "GreaterThanOrEqual(start_time" in plan


def test_top_routes_rank_only_the_rows_of_the_report(trips):
    plan = plan_of(top_routes_last_week(trips, DAYS[1]))
    assert plan.index("Window [dense_rank") < plan.index("TakeOrderedAndProject")


def test_judged_trips_are_not_shuffled(trips):
    stats = sized(route_duration_stats(trips))
    plan = plan_of(trip_outliers(trips, run_scope("main", *DAYS), stats=stats))
    judged = plan[plan.index("BroadcastHashJoin") : plan.index("BroadcastExchange")]
    assert "hashpartitioning" not in judged and "FileScan parquet" in judged
    assert "EqualTo(status,completed)" in judged and "IsNotNull(end_time)" in judged


def test_classifying_moves_no_trip(spark, routes, vehicles, tmp_path):
    spark.createDataFrame([], RAW).write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    plan = plan_of(classify_trips(raw, sized(routes), sized(vehicles), "run", AS_OF))
    assert shuffles(plan) == 0 and scans(plan) == 1 and plan.count("BroadcastHashJoin") == 2


def test_large_merge_shuffles_each_side_once(spark, tmp_path):
    spark.createDataFrame([], SILVER).write.parquet(str(tmp_path / "t"))
    side = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(merge_trips(side, side.withColumn("distance_km", F.lit(1.0))))
    assert shuffles(plan) == 2 and scans(plan) == 2


def test_observed_rows_are_hashed_once(trips):
    parts = {day: f"to_date(start_time) = DATE '{day}'" for day in ("2025-01-12", "2025-01-13", "2025-01-14")}
    observed, _ = observe_fingerprints(trips, parts)
    assert observed.columns == trips.columns
    assert plan_of(observed).count("xxhash64(") == 1
