from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.operators import (
    daily_ridership,
    day_sums,
    enrich_trips,
    hourly_counts,
    latest_daily,
    latest_top_routes,
    load_window,
    peak_hours,
    route_duration_stats,
    sized,
    top_routes_last_week,
    trip_outliers,
    trip_outliers_on,
    weekly_rolling_counts,
    weekly_top_routes,
    worst_outliers,
)
from ridemill.operators.lookup import COPIES, folded_vehicles
from ridemill.operators.outliers import run_scope
from tests.helpers import ENRICHED, plan_of, ride

DAY = "2025-01-12"


def frame(spark, rows):
    return spark.createDataFrame(rows, ENRICHED)


def test_daily_ridership(spark):
    trips = frame(
        spark,
        [
            ride("A7", "R1", f"{DAY} 17:05:00", 14, vehicle="v8", seats=62),
            ride("A8", "R1", f"{DAY} 17:48:00", 41, vehicle="v9", seats=38),
            ride("A9", "R1", f"{DAY} 06:31:00", 26, vehicle="v8", seats=62),
            ride("B1", "R2", f"{DAY} 22:40:00", vehicle="v5", status="in_progress", kind="train", seats=410),
            ride("B2", "R1", "2025-01-13 00:00:00", 19),
        ],
    )
    rows = {r["route_id"]: r for r in daily_ridership(trips, DAY, DAY).collect()}
    assert set(rows) == {"R1", "R2"}
    bus = rows["R1"]
    assert (bus["total_trips"], bus["unique_vehicles"], bus["peak_hour"]) == (3, 2, 17)
    assert bus["avg_duration_minutes"] == pytest.approx(81 / 3)
    assert bus["max_duration_minutes"] == 41.0 and bus["avg_capacity"] == pytest.approx(162 / 3)
    assert (bus["trips_completed"], bus["trips_in_progress"]) == (3, 0)
    train = rows["R2"]
    assert (train["trips_completed"], train["trips_in_progress"]) == (0, 1)
    assert train["avg_duration_minutes"] is None and train["max_duration_minutes"] is None


def test_daily_groups_with_a_null_key_are_left_out(spark):
    trips = frame(
        spark,
        [
            ride("T1", "R1", f"{DAY} 08:00:00", 30, kind=None),
            ride("T2", None, f"{DAY} 08:00:00", 30),
            ride("T3", "R1", f"{DAY} 08:00:00", 30),
        ],
    )
    assert [r["total_trips"] for r in daily_ridership(trips, DAY, DAY).collect()] == [1]


def test_daily_counts_trip_ids_and_distinct_vehicles_without_nulls(spark):
    trips = frame(
        spark,
        [
            ride(None, "R1", f"{DAY} 07:00:00", 30, vehicle=None),
            ride("T2", "R1", f"{DAY} 09:00:00", 30),
            ride(None, "R9", f"{DAY} 05:00:00", 30),
            ride(None, "R9", f"{DAY} 04:00:00", 30),
        ],
    )
    rows = {r["route_id"]: r for r in daily_ridership(trips, DAY, DAY).collect()}
    assert (rows["R1"]["total_trips"], rows["R1"]["unique_vehicles"], rows["R1"]["peak_hour"]) == (1, 1, 9)
    assert (rows["R9"]["total_trips"], rows["R9"]["peak_hour"]) == (0, 4)


def test_peak_hour_tie_takes_the_earlier_hour(spark):
    trips = frame(spark, [ride(f"T{h}{i}", "R1", f"{DAY} {h:02d}:0{i}:00", 5) for h in (3, 17, 23) for i in range(4)])
    assert daily_ridership(trips, DAY, DAY).first()["peak_hour"] == 3
    assert peak_hours(hourly_counts(trips, DAY, DAY)).first()["peak_hour"] == 3


def test_whole_minutes_drop_the_seconds(spark):
    trips = frame(spark, [ride("T1", "R1", f"{DAY} 08:00:59", 62 / 60), ride("T2", "R1", f"{DAY} 08:00:00", 3.99)])
    row = daily_ridership(trips, DAY, DAY, duration="minutes").first()
    assert row["avg_duration_minutes"] == 2.0 and row["max_duration_minutes"] == 3.0


def two_scan_shape(spark, trips, start, end):
    """Daily ridership as two aggregates, a window and a join, to compare with."""
    trips.createOrReplaceTempView("t")
    return spark.sql(
        f"""WITH d AS (SELECT *, date(start_time) AS trip_date, timestampdiff(MICROSECOND, start_time, end_time) / 6e7 AS m
                 FROM t WHERE date(start_time) BETWEEN '{start}' AND '{end}'),
            hours AS (SELECT trip_date, route_id, vehicle_type, hour(start_time) AS h, count(*) AS n FROM d GROUP BY ALL)
        SELECT trip_date, route_id, vehicle_type, count(*) AS total_trips, count(DISTINCT vehicle_id) AS unique_vehicles,
               avg(capacity) AS avg_capacity, avg(m) AS avg_duration_minutes, max(m) AS max_duration_minutes,
               count_if(status = 'completed') AS trips_completed, count_if(status = 'in_progress') AS trips_in_progress,
               any_value(peak_hour) AS peak_hour
        FROM d JOIN (SELECT trip_date, route_id, vehicle_type, max_by(h, struct(n, -h)) AS peak_hour FROM hours GROUP BY ALL)
             USING (trip_date, route_id, vehicle_type)
        GROUP BY ALL"""
    )


def test_hot_route_gives_the_same_daily_rows(spark):
    """A third of all trips are on one route and one day."""
    n, base = F.col("id"), F.lit("2025-01-10 00:00:00").cast("timestamp")
    hot = n % 3 == 0
    offset = F.when(hot, n % 86_400).otherwise((n * 7919) % (3 * 86_400)).cast("int")
    start = F.timestamp_add("SECOND", offset, base)
    trips = spark.range(60_000, numPartitions=6).select(
        F.concat(F.lit("T"), n).alias("trip_id"),
        F.concat(F.lit("V"), n % 211).alias("vehicle_id"),
        F.when(hot, "R000").otherwise(F.concat(F.lit("R"), n % 40)).alias("route_id"),
        start.alias("start_time"),
        F.when(n % 5 != 0, F.timestamp_add("SECOND", (n % 7000).cast("int"), start)).alias("end_time"),
        F.lit(1.0).alias("distance_km"),
        F.when(n % 5 == 0, "in_progress").otherwise("completed").alias("status"),
        F.lit("run").alias("sfn_execution_id"),
        F.when(n % 211 % 2 == 0, "Bus").otherwise("Subway").alias("vehicle_type"),
        (n % 211 % 90).cast("int").alias("capacity"),
    )
    key = lambda r: (r["trip_date"], r["route_id"], r["vehicle_type"])
    mine = {key(r): r.asDict() for r in daily_ridership(trips, "2025-01-10", "2025-01-12").collect()}
    expected = {key(r): r.asDict() for r in two_scan_shape(spark, trips, "2025-01-10", "2025-01-12").collect()}
    assert mine.keys() == expected.keys()
    for k, row in mine.items():
        assert row == pytest.approx(expected[k], nan_ok=True) or all(
            row[c] == pytest.approx(expected[k][c]) for c in row if isinstance(row[c], float)
        )
        exact = {c: v for c, v in row.items() if not isinstance(v, float)}
        assert exact == {c: expected[k][c] for c in exact}


def test_weekly_window_bounds(spark):
    trips = frame(
        spark,
        [
            ride("C1", "R1", "2025-01-05 23:59:59", 12),
            ride("C2", "R1", "2025-01-06 00:00:00", 47),
            ride("C3", "R2", "2025-01-09 13:20:00", 18),
            ride("C4", "R2", "2025-01-11 05:45:00", 22),
            ride("C5", "R2", f"{DAY} 23:59:59", None, status="in_progress"),
        ],
    )
    rows = weekly_top_routes(trips, DAY, DAY).orderBy("route_rank").collect()
    assert [(r["route_rank"], r["route_id"], r["total_trips"], r["total_completed_trips"]) for r in rows] == [
        (1, "R2", 3, 2),
        (2, "R1", 1, 1),
    ]
    assert rows[0]["avg_trip_duration_minutes"] == 20.0


def test_weekly_equals_the_range_join(spark):
    rows = [
        ride(f"T{i}", f"R{i % 13}", f"2025-01-{1 + i * 7 % 20:02d} 0{i % 10}:00:00", None if i % 4 == 0 else i % 50)
        for i in range(400)
    ]
    trips = frame(spark, rows)
    trips.createOrReplaceTempView("w")
    expected = spark.sql(
        """SELECT c AS calculation_date, route_id, count(*) AS n,
                  avg(timestampdiff(MICROSECOND, start_time, end_time) / 6e7) AS m
           FROM (SELECT explode(sequence(DATE '2025-01-04', DATE '2025-01-27')) AS c)
           JOIN w ON date(start_time) BETWEEN c - 6 AND c GROUP BY ALL"""
    ).collect()
    found = {
        (r["calculation_date"], r["route_id"]): (r["total_trips"], r["avg_trip_duration_minutes"])
        for r in weekly_rolling_counts(trips, "2025-01-04", "2025-01-27").collect()
    }
    assert set(found) == {(r["calculation_date"], r["route_id"]) for r in expected}
    for r in expected:
        n, m = found[(r["calculation_date"], r["route_id"])]
        assert n == r["n"] and m == (None if r["m"] is None else pytest.approx(r["m"]))


def test_weekly_keeps_ten_and_breaks_ties_by_route(spark):
    trips = frame(spark, [ride(f"T{i}", f"R{i:02d}", f"{DAY} 08:00:00", 5) for i in range(14)])
    rows = weekly_top_routes(trips, DAY, DAY).orderBy("route_rank").collect()
    assert [r["route_id"] for r in rows] == [f"R{i:02d}" for i in range(10)]
    assert [r["route_rank"] for r in rows] == list(range(1, 11))
    assert "BroadcastNestedLoopJoin" not in plan_of(weekly_top_routes(trips, DAY, DAY))


def test_top_routes_last_week_has_no_upper_bound(spark):
    trips = frame(
        spark,
        [
            ride("T1", "R1", "2025-01-04 23:59:59", 5),
            ride("T2", "R2", "2025-01-05 00:00:00", 5.5),
            ride("T3", "R2", "2026-01-01 00:00:00", 4.0),
        ],
    )
    rows = top_routes_last_week(trips, DAY).collect()
    assert [tuple(r) for r in rows] == [(1, "R2", 2, 2, 4.5)]


def baseline(n=15, route="R1"):
    return [ride(f"B{route}{i}", route, "2025-01-10 08:00:00", 10) for i in range(n)]


def test_outliers_of_a_run(spark):
    trips = frame(
        spark,
        [
            *baseline(),
            ride("normal", "R1", f"{DAY} 14:00:00", 10, run="now"),
            ride("long", "R1", f"{DAY} 15:00:00", 120, run="now"),
            ride("far", "R2", f"{DAY} 16:00:00", 15, km=95.0, run="now"),
            ride("running", "R1", f"{DAY} 16:00:00", None, km=95.0, status="in_progress", run="now"),
            ride("other run", "R3", f"{DAY} 16:00:00", 15, km=95.0, run="old"),
        ],
    )
    rows = {r["trip_id"]: r for r in trip_outliers(trips, run_scope("now", DAY, DAY)).collect()}
    assert set(rows) == {"long", "far"}
    assert rows["long"]["outlier_reason"] == S.OUTLIER_DURATION and rows["long"]["duration_minutes"] == 120.0
    assert rows["far"]["outlier_reason"] == S.OUTLIER_DISTANCE
    assert rows["far"]["z_score"] == 0.0 and rows["far"]["stddev_duration_minutes"] == 0.0
    assert trip_outliers(trips, run_scope("now", DAY, DAY)).columns == S.GOLD_OUTLIERS.column_names
    by_dates = trip_outliers(trips, run_scope("main", DAY, DAY)).collect()
    assert {r["trip_id"] for r in by_dates} == {"long", "far", "other run"}


def test_long_and_far_is_reported_as_long(spark):
    trips = frame(spark, [*baseline(), ride("both", "R1", f"{DAY} 15:00:00", 120, km=95.0, run="now")])
    assert trip_outliers(trips, run_scope("now", DAY, DAY)).first()["outlier_reason"] == S.OUTLIER_DURATION


def test_statistics_join_works_beyond_the_broadcast_limit(spark):
    trips = frame(spark, [*baseline(), ride("long", "R1", f"{DAY} 15:00:00", 120, run="now")])
    stats = sized(route_duration_stats(trips), limit=0)
    scope = run_scope("now", DAY, DAY)
    assert [r["trip_id"] for r in trip_outliers(trips, scope, stats=stats).collect()] == ["long"]


def test_outliers_of_a_day_use_eight_days_and_whole_minutes(spark, vehicles):
    rows = [
        *[ride(f"B{i}", "R1", "2025-01-05 08:00:00", 10.9, vehicle="V0001") for i in range(15)],
        *[ride(f"E{i}", "R1", "2025-01-04 08:00:00", 500, vehicle="V0001") for i in range(15)],
        ride("long", "R1", f"{DAY} 15:00:00", 120.5, vehicle="V0001"),
        ride("yesterday", "R1", "2025-01-11 15:00:00", 10, vehicle="V0001", km=99.0),
        ride("unknown vehicle", "R1", f"{DAY} 15:00:00", 10, vehicle="V9999", km=99.0),
    ]
    trips = frame(spark, rows).drop("vehicle_type", "capacity")
    found = trip_outliers_on(trips, vehicles, DAY).collect()
    assert [(r["trip_id"], r["duration_minutes"]) for r in found] == [("long", 120)]
    assert found[0]["avg_duration_minutes"] == pytest.approx((16 * 10 + 120) / 17)


def test_load_window_pads_and_prunes_days(spark, tmp_path):
    rows = [ride(f"T{d}", "R1", f"2025-01-{d:02d} 23:59:59.5", 5) for d in range(1, 31)]
    path = str(tmp_path / "trips")
    frame(spark, rows).withColumn("start_date", F.to_date("start_time")).write.partitionBy("start_date").parquet(path)
    window = load_window(spark.read.parquet(path), DAY, "2025-01-13")
    days = sorted(r["start_date"] for r in window.collect())
    assert days == [dt.date(2025, 1, d) for d in range(6, 20)]
    plan = plan_of(window)
    assert "start_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(start_time" in plan


def test_enrich_drops_unknown_vehicles(spark, vehicles):
    trips = frame(spark, [ride("a", "R1", DAY, vehicle="V0001"), ride("b", "R1", DAY, vehicle="V7")])
    trips = trips.drop("vehicle_type", "capacity")
    rows = enrich_trips(trips, vehicles).collect()
    assert [(r["trip_id"], r["vehicle_type"], r["capacity"]) for r in rows] == [("a", "Bus", 50)]


def test_broadcast_only_within_the_limit(spark, vehicles, tmp_path):
    vehicles.write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    trips = frame(spark, [ride("a", "R1", DAY, vehicle="V0001")]).drop("vehicle_type", "capacity")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" in plan_of(enrich_trips(trips, sized(stored)))
        beyond = enrich_trips(trips, sized(stored, limit=10))
        assert "SortMergeJoin" in plan_of(beyond) and beyond.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reports_are_ordered_and_short(spark):
    trips = frame(
        spark,
        [ride(f"T{d}{i}", f"R{i:02d}", f"2025-01-{d:02d} 08:00:00", 5 + i, km=90.0) for d in (11, 12) for i in range(12)],
    )
    daily = latest_daily(daily_ridership(trips, "2025-01-11", DAY)).collect()
    assert [r["route_id"] for r in daily] == [f"R{i:02d}" for i in range(10)]
    assert {str(r["trip_date"]) for r in daily} == {DAY}
    weekly = latest_top_routes(weekly_top_routes(trips, "2025-01-11", DAY)).collect()
    assert [r["route_rank"] for r in weekly] == list(range(1, 11))
    worst = worst_outliers(trip_outliers(trips, run_scope("main", "2025-01-11", DAY))).collect()
    scores = [r["z_score"] for r in worst]
    assert len(worst) == 10 and scores == sorted(scores, reverse=True)


def test_vehicles_listed_many_times_meet_a_trip_once_for_each_type(spark):
    listed = [("v1", "bus", 50)] * 40 + [("v1", "bus", None), ("v1", "tram", 90), ("v1", None, 7), ("v2", "bus", None), ("v2", "bus", 30), (None, "bus", 1), ("v9", "bus", 1)]
    vehicles = spark.createDataFrame(listed, "vehicle_id string, vehicle_type string, capacity int")
    rides = [ride(f"T{i % 25}", f"R{i % 3}" if i % 11 else None, f"{DAY} {i % 24:02d}:10:00", 5 + i % 9 if i % 7 else None, vehicle=f"v{i % 4}") for i in range(60)]
    rides += [ride(None, "R1", f"{DAY} 08:00:00", 4), ride("T8", "R1", f"{DAY} 09:00:00", 3000, status="in_progress"), ride("far", "R1", f"{DAY} 09:00:00", 6, km=99.0)]
    trips = frame(spark, rides).drop("vehicle_type", "capacity")
    whole, folded = enrich_trips(trips, vehicles), enrich_trips(trips, folded_vehicles(vehicles))
    assert folded.groupBy("vehicle_id").agg((F.count("*") / F.count_distinct(F.struct("trip_id", "route_id", "start_time", "end_time", "status"))).alias("n")).where("n > 3").isEmpty()
    assert folded.count() < whole.count() / 10 and folded.agg(F.sum(COPIES)).first()[0] == whole.count()
    expected, found = day_sums(whole), day_sums(folded)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in expected.schema]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    stats = spark.createDataFrame([("R1", "bus", 6.0, 1.0)], "route_id string, vehicle_type string, avg_duration_minutes double, stddev_duration_minutes double")
    judged = [trip_outliers(t, run_scope("main", DAY, DAY), stats=stats).collect() for t in (whole, folded)]
    assert sorted(map(repr, judged[0])) == sorted(map(repr, judged[1])) and len(judged[0]) > 41
    with pytest.raises(ValueError):
        trip_outliers(folded, run_scope("main", DAY, DAY))


def test_gold_of_a_run_reads_folded_vehicles(spark, tmp_path):
    from ridemill.plans import ParquetTripStore, run_batch
    from ridemill.plans import batch as plan
    from ridemill.plans.parquet_store import ACTIVE
    from ridemill.sinks import ParquetGoldSink
    from tests.helpers import AS_OF, RAW, raw_row

    vehicles = spark.createDataFrame([("V0001", "bus", 50)] * 30 + [("V0001", "tram", 20)], "vehicle_id string, vehicle_type string, capacity int")
    routes = spark.createDataFrame([("R001",)], "route_id string")
    raw = spark.createDataFrame([raw_row(f"T{i}") for i in range(4)], RAW)
    store, sink = ParquetTripStore(spark, f"{tmp_path}/tables"), ParquetGoldSink(spark, f"{tmp_path}/gold")
    run_batch(raw, routes, vehicles, store, sink, "run_a", AS_OF, f"{tmp_path}/bad", f"{tmp_path}/runs")
    daily = {r["vehicle_type"]: (r["total_trips"], r["avg_capacity"], r["unique_vehicles"]) for r in sink.read(S.GOLD_DAILY).collect()}
    assert daily == {"bus": (120, 50.0, 1), "tram": (4, 20.0, 1)}
    day = dt.date(2025, 1, 20)
    assert store.read(ACTIVE).count() == 4
    assert plan._enriched(store, "main", folded_vehicles(vehicles), [day]).count() == 8
