from __future__ import annotations

import random

from pyspark.sql import functions as F

from ridemill.operators import dedupe_batch, latest_per_trip
from tests.helpers import SILVER, plan_of, silver_row

DAY = "2025-01-20"


def test_exact_copies_leave_the_completed_then_the_longest(spark):
    a, b = f"{DAY} 08:00:00", f"{DAY} 08:30:00"
    rows = [
        silver_row("T1", a, b, "in_progress", 9.0),
        silver_row("T1", a, b, "completed", 5.0),
        silver_row("T1", a, b, "completed", 7.0),
        silver_row("T1", a, b, "completed", None),
        silver_row("T1", a, f"{DAY} 08:31:00", "completed", 1.0),
        silver_row("T2", a, None, "in_progress", 1.0),
        silver_row("T2", a, None, "in_progress", 2.0),
    ]
    kept = dedupe_batch(spark.createDataFrame(rows, SILVER)).collect()
    assert sorted((r["trip_id"], r["status"], r["distance_km"]) for r in kept) == [
        ("T1", "completed", 1.0),
        ("T1", "completed", 7.0),
        ("T2", "in_progress", 2.0),
    ]


def test_latest_prefers_completed_then_the_last_end(spark):
    start = f"{DAY} 08:00:00"
    rows = [
        silver_row("T1", start, f"{DAY} 09:00:00", "in_progress"),
        silver_row("T1", start, f"{DAY} 08:10:00", "completed"),
        silver_row("T1", start, f"{DAY} 08:20:00", "completed"),
        silver_row("T1", start, None, "completed"),
        silver_row("T2", start, None, "in_progress", 1.0),
        silver_row("T2", f"{DAY} 08:05:00", None, "in_progress", 1.0),
    ]
    kept = {r["trip_id"]: r for r in latest_per_trip(spark.createDataFrame(rows, SILVER)).collect()}
    assert str(kept["T1"]["end_time"]) == f"{DAY} 08:20:00"
    assert str(kept["T2"]["start_time"]) == f"{DAY} 08:05:00"


def test_same_row_is_kept_in_any_input_order(spark):
    start, end = f"{DAY} 08:00:00", f"{DAY} 08:30:00"
    rows = [silver_row("T1", start, end, run=f"run_{i % 5}", route=f"R00{i % 3}") for i in range(30)]
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SILVER).repartition(seed + 1)
        seen.add(tuple(latest_per_trip(df).first()))
    assert len(seen) == 1


def test_a_hot_trip_is_cut_down_before_the_shuffle(spark):
    """A third of the rows share one trip; each task sends one row of it."""
    n = 30_000
    hot = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id")))
    start = F.lit(f"{DAY} 08:00:00").cast("timestamp")
    df = spark.range(n, numPartitions=4).select(
        hot.alias("trip_id"),
        F.lit("R001").alias("route_id"),
        F.lit("V0001").alias("vehicle_id"),
        F.lit("completed").alias("status"),
        start.alias("start_time"),
        F.timestamp_add("SECOND", F.col("id").cast("int"), start).alias("end_time"),
        F.lit(1.0).alias("distance_km"),
    )
    kept = latest_per_trip(df)
    assert kept.count() == n - n // 3 + 1
    last = kept.where("trip_id = 'HOT'").select(F.max("end_time")).first()[0]
    assert last == df.where("trip_id = 'HOT'").select(F.max("end_time")).first()[0]
    for frame in (kept, dedupe_batch(df)):
        plan = plan_of(frame)
        exchange = plan.index("Exchange hashpartitioning")
        limits = [i for i in range(len(plan)) if plan.startswith("WindowGroupLimit", i)]
        assert any(i > exchange for i in limits), plan
