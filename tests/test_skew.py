"""A route or vehicle with a third of all rows, with lookups too large to broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.operators import classify_trips, enrich_trips, unique_lookup
from tests.helpers import AS_OF, RAW, plan_of

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}
ROWS = 120_000


@pytest.fixture()
def no_broadcast(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.fixture()
def stored(spark, tmp_path):
    """Raw rows, routes and vehicles as Parquet; every third row is on route 7, vehicle 7."""
    n = F.col("id")
    hot = n % 3 == 0
    rows = spark.range(ROWS, numPartitions=8).select(
        F.concat(F.lit("T"), n).alias("trip_id"),
        F.concat(F.lit("v"), F.when(hot, 7).otherwise(n % 500)).alias("vehicle_id"),
        F.concat(F.lit("r"), F.when(hot, 7).otherwise(n % 200)).alias("route_id"),
        F.lit("2025-01-20 08:00:00").alias("start_time"),
        F.lit("2025-01-20 08:30:00").alias("end_time"),
        F.lit(5.0).alias("distance_km"),
        F.lit("completed").alias("status"),
        F.lit(None).cast("string").alias("vehicle_id_raw"),
        F.sha2(n.cast("string"), 256).alias("note"),
        F.lit(None).cast("string").alias(S.CORRUPT_COLUMN),
    )
    assert rows.columns == [part.split()[0] for part in RAW.split(", ")]
    routes = spark.range(150).select(F.concat(F.lit("R"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("route_id"))
    vehicles = spark.range(400).select(
        F.concat(F.lit("V"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("vehicle_id"),
        F.lit("Bus").alias("vehicle_type"),
        F.lit(50).alias("capacity"),
    )
    frames = {"raw": rows, "routes": routes, "vehicles": vehicles}
    for name, frame in frames.items():
        frame.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in frames}


def test_hot_keys_are_split_and_judged_alike(spark, stored, no_broadcast):
    routes = unique_lookup(stored["routes"], "route_id", limit=0)
    vehicles = unique_lookup(stored["vehicles"], "vehicle_id", limit=0)
    judged = classify_trips(stored["raw"], routes, vehicles, "run", AS_OF)
    counts = judged.groupBy(S.REASON_COLUMN).count()
    found = {r[0]: r[1] for r in counts.collect()}
    expected = {None: 0, S.REASON_ROUTE: 0, S.REASON_VEHICLE: 0}
    for n in range(ROWS):
        route, vehicle = (7, 7) if n % 3 == 0 else (n % 200, n % 500)
        expected[S.REASON_ROUTE if route >= 150 else S.REASON_VEHICLE if vehicle >= 400 else None] += 1
    assert found == expected
    assert plan_of(counts).count("skew=true") == 2


def test_hot_vehicle_is_split_when_enriching(spark, stored, no_broadcast):
    trips = stored["raw"].withColumn("vehicle_id", F.concat(F.lit("V"), F.lpad(F.substring("vehicle_id", 2, 4), 4, "0")))
    enriched = enrich_trips(trips, stored["vehicles"])
    total = enriched.agg(F.count("capacity"), F.max("note"))
    assert total.collect()[0][0] == sum(1 for n in range(ROWS) if n % 3 == 0 or n % 500 < 400)
    assert "skew=true" in plan_of(total)
