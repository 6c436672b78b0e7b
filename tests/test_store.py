from __future__ import annotations

import datetime as dt
import glob
import shutil
import time

import pytest
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.plans import ParquetTripStore, run_batch, run_gold, run_silver
from ridemill.plans.parquet_store import ACTIVE, HISTORY
from ridemill.session import SORTED_SPLIT_BYTES, SPLIT_SETTING, write_note
from ridemill.sinks import ParquetGoldSink, first_attempt_time, read_quarantine, read_run_metadata
from tests.helpers import AS_OF, RAW, raw_row


@pytest.fixture()
def place(spark, tmp_path):
    class Place:
        root = str(tmp_path)
        store = ParquetTripStore(spark, f"{tmp_path}/tables")
        sink = ParquetGoldSink(spark, f"{tmp_path}/gold")
        bad = f"{tmp_path}/bad"
        runs = f"{tmp_path}/runs"

    return Place


def silver(spark, place, routes, vehicles, run_id, rows):
    raw = spark.createDataFrame(rows, RAW)
    return run_silver(raw, routes, vehicles, place.store, run_id, AS_OF, place.bad, place.runs)


def trips_of(df):
    return sorted((r["trip_id"], r["status"], r[S.RUN_COLUMN]) for r in df.collect())


FIRST = [
    raw_row("T1", status="in_progress", start="2025-01-18 08:00:00", end="2025-01-18 08:05:00"),
    raw_row("T2", start="2025-01-19 08:00:00", end="2025-01-19 08:30:00"),
    raw_row("T2", start="2025-01-19 08:00:00", end="2025-01-19 08:30:00"),
    raw_row("T9", route="r77"),
]
SECOND = [
    raw_row("T1", start="2025-01-18 08:00:00", end="2025-01-18 08:40:00"),
    raw_row("T3", start="2025-01-20 08:00:00", end="2025-01-20 08:30:00"),
]


def test_branch_is_isolated_until_published(spark, place, routes, vehicles):
    result = silver(spark, place, routes, vehicles, "run_a", FIRST)
    assert (result.clean_count, result.start_date, result.end_date) == (2, "2025-01-18", "2025-01-19")
    assert result.bad_counts == {S.REASON_ROUTE: 1}
    assert place.store.read(ACTIVE).count() == 0 and place.store.read(HISTORY).count() == 0
    assert trips_of(place.store.read(ACTIVE, "run_a")) == [("T1", "in_progress", "run_a"), ("T2", "completed", "run_a")]
    place.store.publish("run_a")

    silver(spark, place, routes, vehicles, "run_b", SECOND)
    assert trips_of(place.store.read(ACTIVE)) == [("T1", "in_progress", "run_a"), ("T2", "completed", "run_a")]
    after = [("T1", "completed", "run_b"), ("T2", "completed", "run_a"), ("T3", "completed", "run_b")]
    assert trips_of(place.store.read(ACTIVE, "run_b")) == after
    assert place.store.read(HISTORY, "run_b").count() == 4
    place.store.publish("run_b")
    assert trips_of(place.store.read(ACTIVE)) == after
    assert place.store.read(HISTORY).count() == 4
    days = {p.rsplit("=")[1] for p in glob.glob(f"{place.root}/tables/main/active/start_date=*")}
    assert days == {"2025-01-18", "2025-01-19", "2025-01-20"}


def test_repeating_a_run_or_a_publish_changes_nothing(spark, place, routes, vehicles):
    for run_id, rows in (("run_a", FIRST), ("run_b", SECOND)):
        silver(spark, place, routes, vehicles, run_id, rows)
        place.store.publish(run_id)
    active, history = trips_of(place.store.read(ACTIVE)), trips_of(place.store.read(HISTORY))
    silver(spark, place, routes, vehicles, "run_b", SECOND)
    place.store.publish("run_b")
    place.store.publish("run_b")
    assert trips_of(place.store.read(ACTIVE)) == active
    assert trips_of(place.store.read(HISTORY)) == history


def test_large_source_takes_the_shuffled_merge_to_the_same_result(spark, place, routes, vehicles, monkeypatch):
    silver(spark, place, routes, vehicles, "run_a", FIRST)
    place.store.publish("run_a")
    monkeypatch.setattr("ridemill.plans.batch.BROADCAST_LIMIT_BYTES", 0)
    silver(spark, place, routes, vehicles, "run_b", SECOND)
    assert trips_of(place.store.read(ACTIVE, "run_b")) == [
        ("T1", "completed", "run_b"),
        ("T2", "completed", "run_a"),
        ("T3", "completed", "run_b"),
    ]


def test_quarantine_and_metadata_of_a_run(spark, place, routes, vehicles):
    silver(spark, place, routes, vehicles, "run_a", FIRST)
    silver(spark, place, routes, vehicles, "run_a", FIRST)
    schema = "trip_id string, quarantine_reason string, quarantined_at timestamp"
    from pyspark.sql import types as T

    bad = read_quarantine(spark, place.bad, "run_a", T.StructType.fromDDL(schema)).collect()
    assert [(r["trip_id"], r["quarantine_reason"]) for r in bad] == [("T9", S.REASON_ROUTE)]
    assert bad[0]["quarantined_at"] is not None
    assert tuple(read_run_metadata(spark, place.runs, "run_a").first()) == ("run_a", "2025-01-18", "2025-01-19")


def test_batch_without_clean_rows_stops_after_silver(spark, place, routes, vehicles):
    raw = spark.createDataFrame([raw_row(trip=None)], RAW)
    result = run_batch(
        raw, routes, vehicles, place.store, place.sink, "run_x", AS_OF, place.bad, place.runs
    )
    assert not result.has_clean_rows and result.clean_count == 0
    assert tuple(read_run_metadata(spark, place.runs, "run_x").first()) == ("run_x", None, None)
    assert glob.glob(f"{place.root}/gold/*") == []
    assert place.store.read(ACTIVE).count() == 0


def test_batch_without_bad_rows_writes_no_quarantine(spark, place, routes, vehicles):
    silver(spark, place, routes, vehicles, "run_b", SECOND)
    assert glob.glob(f"{place.bad}/*") == []


def test_keys_that_a_dimension_holds_twice_do_not_multiply_raw_rows(spark, place, routes, vehicles):
    nobody = spark.createDataFrame([(None, "Bus", 1)], vehicles.schema)
    result = silver(spark, place, routes.unionByName(routes), vehicles.unionByName(vehicles).unionByName(nobody), "run_a", FIRST)
    assert (result.clean_count, result.bad_counts) == (2, {S.REASON_ROUTE: 1})
    assert spark.read.json(f"{place.bad}/run_a").count() == 1


def test_a_batch_with_other_columns_is_refused(spark, place, routes, vehicles):
    silver(spark, place, routes, vehicles, "run_a", FIRST)
    raw = spark.createDataFrame(SECOND, RAW).drop("note")
    with pytest.raises(ValueError):
        run_silver(raw, routes, vehicles, place.store, "run_b", AS_OF, place.bad, place.runs)


def test_a_repeated_run_is_judged_by_its_first_time(spark, place):
    first = first_attempt_time(spark, place.runs, "run_a")
    time.sleep(1.1)
    assert first_attempt_time(spark, place.runs, "run_a") == first
    assert first_attempt_time(spark, place.runs, "run_b") > first


def test_main_is_written_at_once_and_appends_history(spark, place, routes, vehicles):
    silver(spark, place, routes, vehicles, "main", FIRST)
    silver(spark, place, routes, vehicles, "main", SECOND)
    assert place.store.read(ACTIVE).count() == 3
    assert place.store.read(HISTORY).count() == 4


def test_gold_publishes_only_after_the_sink_took_the_rows(spark, place, routes, vehicles):
    class Refusing:
        def replace(self, writes):
            raise RuntimeError("database is down")

    result = silver(spark, place, routes, vehicles, "run_a", FIRST)
    with pytest.raises(RuntimeError):
        run_gold(vehicles, place.store, Refusing(), "run_a", result.start_date, result.end_date)
    assert place.store.read(ACTIVE).count() == 0
    run_gold(vehicles, place.store, place.sink, "run_a", result.start_date, result.end_date, persist=True)
    assert place.store.read(ACTIVE).count() == 2
    assert place.sink.read(S.GOLD_DAILY).count() == 2
    weekly = place.sink.read(S.GOLD_WEEKLY)
    assert str(weekly.agg(F.max("calculation_date")).first()[0]) == "2025-01-25"
    assert place.sink.read(S.GOLD_OUTLIERS).count() == 0


def test_a_hot_day_is_written_by_many_tasks(spark, tmp_path):
    """Most rows start on one day; with a small advisory size AQE splits that day."""
    store = ParquetTripStore(spark, str(tmp_path))
    n = F.col("id")
    start = F.timestamp_add("DAY", F.when(n % 10 < 8, 0).otherwise(n % 5).cast("int"), F.lit("2025-01-10").cast("timestamp"))
    rows = spark.range(200_000, numPartitions=8).select(
        F.sha2(n.cast("string"), 256).alias("trip_id"),
        F.lit("R001").alias("route_id"),
        F.lit("V0001").alias("vehicle_id"),
        F.lit("completed").alias("status"),
        start.alias("start_time"),
        start.alias("end_time"),
        F.lit(1.0).alias("distance_km"),
        start.alias("ingested_at"),
        F.lit("run_a").alias(S.RUN_COLUMN),
    )
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1mb")
        store.init_tables(rows)
        assert store.append_history("run_a", rows)["clean_count"] == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = glob.glob(f"{tmp_path}/branches/run_a/history/start_date=2025-01-10/*/*.parquet")
    cold = glob.glob(f"{tmp_path}/branches/run_a/history/start_date=2025-01-12/*/*.parquet")
    assert len(hot) >= 4 and len(cold) <= 2
    assert store.batch_rows("run_a").count() == 200_000


def test_a_publish_that_was_cut_off_is_finished_first(spark, place, routes, vehicles):
    """A driver that dies between deleting a day and renaming it in leaves it on the branch alone."""
    silver(spark, place, routes, vehicles, "run_a", FIRST)
    place.store.publish("run_a")
    again = [raw_row("T4", start="2025-01-19 10:00:00", end="2025-01-19 10:30:00")]
    silver(spark, place, routes, vehicles, "run_b", again)
    write_note(spark, f"{place.root}/tables/publishing/run_b", "")
    shutil.rmtree(f"{place.root}/tables/main/active/start_date=2025-01-19")
    silver(spark, place, routes, vehicles, "run_b", again)
    place.store.publish("run_b")
    assert [t[0] for t in trips_of(place.store.read(ACTIVE))] == ["T1", "T2", "T4"]
    assert [t[0] for t in trips_of(place.store.read(HISTORY))] == ["T1", "T2", "T4"]
    assert glob.glob(f"{place.root}/tables/publishing/*") == []


def test_a_publish_of_main_that_was_cut_off_does_not_append_twice(spark, place, routes, vehicles):
    silver(spark, place, routes, vehicles, "main", FIRST)
    write_note(spark, f"{place.root}/tables/publishing/main", "0")
    place.store.finish_publishes()
    assert place.store.read(HISTORY).count() == 2
    write_note(spark, f"{place.root}/tables/publishing/main", "1")
    with pytest.raises(RuntimeError):
        place.store.finish_publishes()


def test_only_branches_published_long_ago_are_removed(spark, place, routes, vehicles):
    for run_id in ("run_a", "run_b", "run_c"):
        silver(spark, place, routes, vehicles, run_id, SECOND)
    place.store.publish("run_a")
    place.store.publish("run_b")
    write_note(spark, f"{place.root}/tables/publishing/run_b", "")
    assert place.store.expire_branches() == []
    assert place.store.expire_branches(time.time() + 6 * 86_400) == ["run_a"]
    left = {p.rsplit("/", 1)[1] for p in glob.glob(f"{place.root}/tables/branches/*")}
    assert left == {"run_b", "run_c"}
    assert place.store.read(ACTIVE).count() == 2


def test_a_read_lists_only_the_days_it_wants(spark, place, routes, vehicles):
    silver(spark, place, routes, vehicles, "run_a", FIRST)
    place.store.publish("run_a")
    silver(spark, place, routes, vehicles, "run_b", SECOND)
    wanted = [dt.date(2025, 1, 19), dt.date(2025, 1, 20), dt.date(2025, 1, 21)]
    for branch, days in (("main", {"2025-01-19"}), ("run_b", {"2025-01-19", "2025-01-20"})):
        rows = place.store.read(ACTIVE, branch, wanted)
        assert {f.split("start_date=")[1][:10] for f in rows.inputFiles()} == days
    assert place.store.read(ACTIVE, "main", []).count() == 0


def test_another_time_zone_is_refused(spark, place, routes, vehicles):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError):
            silver(spark, place, routes, vehicles, "run_a", FIRST)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_only_the_days_of_the_run_are_judged(spark, place, routes, vehicles):
    """Statistics read the padded window, the judged trips their own days."""
    plans = []

    class Looking:
        def replace(self, writes):
            plans.extend(w.rows._jdf.queryExecution().optimizedPlan().toString() for w in writes if w.table is S.GOLD_OUTLIERS)

    result = silver(spark, place, routes, vehicles, "run_a", SECOND[1:])
    run_gold(vehicles, place.store, Looking(), "run_a", result.start_date, result.end_date)
    assert "2025-01-20" in plans[0] and "2025-01-14" not in plans[0]


def test_a_write_sorts_small_splits_of_its_files(spark, place):
    class Writer:
        """Stands for rows and their writer; notes what a task reads while they are written."""

        seen = []

        def __getattr__(self, name):
            return self if name == "write" else lambda *a, **b: self

        def parquet(self, path):
            self.seen.append(spark.conf.get(SPLIT_SETTING))

    before = spark.conf.get(SPLIT_SETTING)
    try:
        for given, wanted in (("128MB", str(SORTED_SPLIT_BYTES)), ("1m", "1m")):
            spark.conf.set(SPLIT_SETTING, given)
            for mode in ("append", "static"):
                place.store._write(Writer(), ACTIVE, "nowhere", mode)
            assert Writer.seen == [wanted, wanted] and spark.conf.get(SPLIT_SETTING) == given
            Writer.seen.clear()
    finally:
        spark.conf.set(SPLIT_SETTING, before)
