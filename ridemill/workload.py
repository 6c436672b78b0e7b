"""One named query per operator, over the driver's tables."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemill import fixtures as X
from ridemill import operators as op
from ridemill import schema as S
from ridemill.functions import between_days, date_spine
from ridemill.operators.lookup import unique_lookup
from ridemill.operators.outliers import run_scope
from ridemill.plans import ParquetTripStore, run_batch, run_silver
from ridemill.plans.parquet_store import ACTIVE, HISTORY, RETAIN_DAYS
from ridemill.session import names_in, scratch_path
from ridemill.sinks import (
    GoldWrite,
    ParquetGoldSink,
    read_quarantine,
    read_run_metadata,
    write_quarantine,
    write_run_metadata,
)
from ridemill.sources import discover_csv_schema, distinct_paths, parse_trip_lines, read_dimension, read_trips_by_name, read_trips_csv
from ridemill.streaming import stream_silver

Query = Callable[[SparkSession, str], DataFrame]

WHOLE = (X.FIRST_DAY, X.LAST_DAY)
WHOLE_WEEKLY = (X.FIRST_DAY, X.LAST_CALCULATION_DAY)
WEEK = ("2024-01-19", X.AS_OF)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.enrich_trips(X.trips(spark, sf_dir), X.dim_vehicles(spark, sf_dir))


def daily_ridership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.daily_ridership(enriched(spark, sf_dir), *WHOLE)


def daily_ridership_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.daily_ridership(enriched(spark, sf_dir), *WHOLE, duration="minutes")


def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hourly_counts(enriched(spark, sf_dir), *WHOLE)


def peak_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.peak_hours(hourly_counts(spark, sf_dir))


def weekly_rolling_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.weekly_rolling_counts(enriched(spark, sf_dir), *WHOLE_WEEKLY)


def weekly_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.weekly_top_routes(enriched(spark, sf_dir), *WHOLE_WEEKLY)


def top_routes_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.top_routes_last_week(X.trips(spark, sf_dir), X.AS_OF)


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day from the first event to the last."""
    day = F.to_date("ts")
    ends = X.table(spark, sf_dir, "events").agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return date_spine(spark, ends["first"], ends["last"])


def _rounded(outliers: DataFrame) -> DataFrame:
    names = ("avg_duration_minutes", "stddev_duration_minutes", "z_score")
    return outliers.withColumns({n: F.round(n, 6) for n in names if n in outliers.columns})


def trip_outliers_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.trip_outliers(enriched(spark, sf_dir), run_scope(X.RUN_ID, *WHOLE)))


def trip_outliers_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.trip_outliers(enriched(spark, sf_dir), run_scope("main", *WHOLE)))


def trip_outliers_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(op.trip_outliers_on(X.trips(spark, sf_dir), X.dim_vehicles(spark, sf_dir), X.AS_OF))


def route_duration_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = op.route_duration_stats(enriched(spark, sf_dir))
    spread = F.round(F.coalesce("stddev_duration_minutes", F.lit(0.0)), 6)
    return stats.withColumn("stddev_duration_minutes", spread)


def zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = op.score_trips(enriched(spark, sf_dir), run_scope("main", *WHOLE))
    return scored.select("trip_id", "duration_minutes", F.round("z_score", 6).alias("z_score"))


def load_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.load_window(X.trips(spark, sf_dir), X.AS_OF, X.AS_OF)


def _naive(df: DataFrame) -> DataFrame:
    """Times without zone, as DuckDB has them."""
    stamps = ("start_time", "end_time", "ingested_at")
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps if c in df.columns})


def normalize_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsable = X.raw_trips(spark, sf_dir).where(F.col(S.CORRUPT_COLUMN).isNull())
    return _naive(op.normalize_trips(parsable, X.BATCH_ID, X.AS_OF))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.classify_trips(
        X.raw_trips(spark, sf_dir),
        X.dim_routes(spark, sf_dir),
        X.dim_vehicles(spark, sf_dir),
        X.BATCH_ID,
        X.AS_OF,
    )


def classify_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    readable = F.when(F.col(S.CORRUPT_COLUMN).isNull(), F.col("trip_id")).alias("trip_id")
    return classified(spark, sf_dir).select(readable, "note", S.REASON_COLUMN)


def quarantine_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.reason_counts(op.quarantine_rows(classified(spark, sf_dir), X.AS_OF))


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(op.split_clean_bad(classified(spark, sf_dir))[0])


def semi_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.known_keys(X.trips(spark, sf_dir), X.dim_routes(spark, sf_dir), "route_id")


def anti_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unknown_keys(X.trips(spark, sf_dir), X.dim_routes(spark, sf_dir), "route_id")


def anti_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unknown_keys(X.trips(spark, sf_dir), X.dim_vehicles(spark, sf_dir), "vehicle_id")


def dedupe_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.dedupe_batch(X.deliveries(spark, sf_dir))


def latest_per_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_per_trip(X.deliveries(spark, sf_dir))


def merge_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.merge_trips(X.trips(spark, sf_dir), X.redelivered_trips(spark, sf_dir))


def merge_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.merge_trips(X.trips(spark, sf_dir), X.redelivered_trips(spark, sf_dir), null_end="open")


def merge_small_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge without a shuffle of the target, where the batch measures small enough."""
    source = X.redelivered_trips(spark, sf_dir)
    return op.merge_trips(X.trips(spark, sf_dir), source, source_fits_broadcast=op.fits_broadcast(source))


def replace_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = X.redelivered_trips(spark, sf_dir).where(between_days(F.col("start_time"), *WEEK))
    return op.replace_date_range(X.trips(spark, sf_dir), new, "start_time", *WEEK)


def latest_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_daily(daily_ridership(spark, sf_dir))


def latest_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_top_routes(weekly_top_routes(spark, sf_dir))


def worst_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.worst_outliers(trip_outliers_dates(spark, sf_dir))


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the observation reports once the observed rows have been written."""
    observed, metrics = op.observe_batch(clean_trips(spark, sf_dir))
    observed.write.format("noop").mode("overwrite").save()
    found = metrics.get
    return spark.range(1).select(
        F.lit(found["clean_count"]).cast("bigint").alias("clean_count"),
        F.lit(found["start_date"]).cast("string").alias("start_date"),
        F.lit(found["end_date"]).cast("string").alias("end_date"),
    )


def from_csv_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = parse_trip_lines(X.csv_lines(spark, sf_dir))
    return rows.select("trip_id", F.col(S.CORRUPT_COLUMN).isNotNull().alias("is_corrupt"))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written CSV files, read back and validated."""
    folder = scratch_path(spark, "landing")
    X.land_csv(spark, sf_dir, folder)
    dims = X.dim_routes(spark, sf_dir), X.dim_vehicles(spark, sf_dir)
    judged = op.classify_trips(read_trips_csv(spark, folder), *dims, X.BATCH_ID, X.AS_OF)
    return judged.select("trip_id", S.REASON_COLUMN, F.col(S.CORRUPT_COLUMN).isNotNull().alias("is_corrupt"))


def announced_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_paths(X.table(spark, sf_dir, "pages").withColumnRenamed("url", "path"))


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One row of each key: a raw row is rejected once, however often the lookups hold its keys.
    known = (unique_lookup(d.select(key), key) for d, key in ((X.dim_routes(spark, sf_dir), "route_id"), (X.dim_vehicles(spark, sf_dir), "vehicle_id")))
    bad = op.quarantine_rows(op.classify_trips(X.raw_trips(spark, sf_dir), *known, X.BATCH_ID, X.AS_OF), X.AS_OF)
    root = scratch_path(spark, "quarantine")
    write_quarantine(bad, root, X.BATCH_ID)
    return read_quarantine(spark, root, X.BATCH_ID, bad.schema).select(
        "trip_id", "note", S.REASON_COLUMN, S.CORRUPT_COLUMN, F.col("quarantined_at").cast("timestamp_ntz").alias("quarantined_at")
    )


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "metadata")
    found = batch_metrics(spark, sf_dir).first()
    write_run_metadata(spark, root, X.BATCH_ID, found["start_date"], found["end_date"])
    return read_run_metadata(spark, root, X.BATCH_ID)


def _staged(spark: SparkSession, sf_dir: str, steps: tuple[str, ...]) -> ParquetTripStore:
    """A store after the steps: `a` and `b` stage all trips and their redelivery, `+a` and `+b` publish them, `a=b` stages the redelivery as run a."""
    root = scratch_path(spark, "store")
    store = ParquetTripStore(spark, f"{root}/tables")
    dims = X.dim_routes(spark, sf_dir), X.dim_vehicles(spark, sf_dir)
    batches = {"a": X.trips(spark, sf_dir), "b": X.redelivered_trips(spark, sf_dir)}
    for step in steps:
        if step.startswith("+"):
            store.publish(f"run_{step[1:]}")
            continue
        rows = batches[step[-1]].drop(S.RUN_COLUMN)
        run_silver(rows, *dims, store, f"run_{step[0]}", X.AFTER_LAST, f"{root}/bad", f"{root}/runs")
    return store


def _two_runs(spark: SparkSession, sf_dir: str) -> ParquetTripStore:
    """All trips as one published run, and their redelivery as a staged one."""
    return _staged(spark, sf_dir, ("a", "+a", "b"))


def two_staged_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current trips after two runs on the same days were staged side by side and then published."""
    return _staged(spark, sf_dir, ("a", "b", "+a", "+b")).read(ACTIVE).drop(S.DAY_COLUMN, "ingested_at")


def branch_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a staged run holds, read back and compared with what was noted while it was written."""
    return _two_runs(spark, sf_dir).audit("run_b").select("table", S.DAY_COLUMN, "found_rows", "intact")


def restaged_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current trips after a published run was staged again and old branches were removed before its second publish."""
    store = _staged(spark, sf_dir, ("a", "+a", "a=b"))
    store.expire_branches(time.time() + 2 * RETAIN_DAYS * 86_400)
    store.publish("run_a")
    return store.read(ACTIVE).drop(S.DAY_COLUMN, "ingested_at")


def branch_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current trips as the staged run sees them."""
    return _two_runs(spark, sf_dir).read(ACTIVE, "run_b").drop(S.DAY_COLUMN, "ingested_at")


def branch_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history on main after the second run is published."""
    store = _two_runs(spark, sf_dir)
    store.publish("run_b")
    return store.read(HISTORY).drop(S.DAY_COLUMN, "ingested_at")


def gold_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily ridership in files, with one week replaced from the redelivered trips."""
    sink = ParquetGoldSink(spark, scratch_path(spark, "gold"))
    again = op.enrich_trips(X.redelivered_trips(spark, sf_dir), X.dim_vehicles(spark, sf_dir))
    sink.replace([GoldWrite(S.GOLD_DAILY, daily_ridership(spark, sf_dir), *WHOLE)])
    sink.replace([GoldWrite(S.GOLD_DAILY, op.daily_ridership(again, *WEEK), *WEEK)])
    return sink.read(S.GOLD_DAILY)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files worked off as a stream, three to a batch; the current trips it leaves."""
    root = scratch_path(spark, "stream")
    X.land_csv(spark, sf_dir, f"{root}/landing", files=6)
    store = ParquetTripStore(spark, f"{root}/tables")
    stream_silver(
        spark,
        f"{root}/landing",
        f"{root}/checkpoint",
        X.dim_routes(spark, sf_dir),
        X.dim_vehicles(spark, sf_dir),
        store,
        ParquetGoldSink(spark, f"{root}/gold"),
        f"{root}/bad",
        f"{root}/runs",
        as_of=X.AS_OF,
        max_files=3,
    ).awaitTermination()
    return _naive(store.read(ACTIVE).drop(S.DAY_COLUMN, S.RUN_COLUMN))


def _stream(spark: SparkSession, sf_dir: str, root: str, on_batch=None, max_files: int = 6):
    """Work off what lies in the landing folder; True if all batches went through."""
    store = ParquetTripStore(spark, f"{root}/tables")
    query = stream_silver(
        spark,
        f"{root}/landing",
        f"{root}/checkpoint",
        X.dim_routes(spark, sf_dir),
        X.dim_vehicles(spark, sf_dir),
        store,
        ParquetGoldSink(spark, f"{root}/gold"),
        f"{root}/bad",
        f"{root}/runs",
        as_of=X.AS_OF,
        max_files=max_files,
        on_batch=on_batch,
    )
    query.awaitTermination()
    return store


def stream_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the files arrive after a first run, dated three weeks before the others."""
    root = scratch_path(spark, "late")
    X.land_csv(spark, sf_dir, f"{root}/sent", files=6)
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(f"{root}/landing"))
    files = sorted((n, t) for n, t in names_in(spark, f"{root}/sent").items() if n.endswith(".csv"))
    for late in (False, True):
        for place, (name, changed) in enumerate(files):
            if (place % 2 == 1) == late:
                if late:
                    system.setTimes(path(f"{root}/sent/{name}"), changed - 21 * 86_400_000, -1)
                system.rename(path(f"{root}/sent/{name}"), path(f"{root}/landing/{name}"))
        store = _stream(spark, sf_dir, root)
    return _naive(store.read(ACTIVE).drop(S.DAY_COLUMN, S.RUN_COLUMN))


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is given again after its publish: rows of both tables with their day and batch."""
    root = scratch_path(spark, "replay")
    X.land_csv(spark, sf_dir, f"{root}/landing", files=4)
    done = []

    def fail_once(result):
        done.append(result)
        if len(done) == 1:
            raise RuntimeError("lost after the publish")

    try:
        _stream(spark, sf_dir, root, fail_once)
    except StreamingQueryException:
        pass
    store = _stream(spark, sf_dir, root, fail_once)
    if len(done) != 2 or done[0].run_id != done[1].run_id:
        raise RuntimeError("the batch was not given again")
    batch = F.regexp_extract(S.RUN_COLUMN, "_([0-9]+)$", 1).cast("int").alias("batch")
    both = [store.read(name).select(F.lit(name).alias("kept_in"), "trip_id", S.DAY_COLUMN, batch) for name in (ACTIVE, HISTORY)]
    return both[0].unionByName(both[1])


def _gold_of_two_runs(spark: SparkSession, sf_dir: str, table: S.GoldTable) -> DataFrame:
    """A business table after all trips, and then their redelivery, have gone through silver and gold."""
    root = scratch_path(spark, "two-runs")
    store, sink = ParquetTripStore(spark, f"{root}/tables"), ParquetGoldSink(spark, f"{root}/gold")
    dims = X.dim_routes(spark, sf_dir), X.dim_vehicles(spark, sf_dir)
    for run_id, rows in (("run_a", X.trips(spark, sf_dir)), ("run_b", X.redelivered_trips(spark, sf_dir))):
        run_batch(rows.drop(S.RUN_COLUMN), *dims, store, sink, run_id, X.AFTER_LAST, f"{root}/bad", f"{root}/runs")
    return sink.read(table)


def run_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_of_two_runs(spark, sf_dir, S.GOLD_DAILY)


def run_gold_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_of_two_runs(spark, sf_dir, S.GOLD_WEEKLY)


def run_gold_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _naive(_rounded(_gold_of_two_runs(spark, sf_dir, S.GOLD_OUTLIERS)))


def gold_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch in which no row is accepted: silver ends it, no business table is made."""
    root = scratch_path(spark, "skipped")
    store, sink = ParquetTripStore(spark, f"{root}/tables"), ParquetGoldSink(spark, f"{root}/gold")
    rows = X.trips(spark, sf_dir).drop(S.RUN_COLUMN).withColumn("route_id", F.lit("R999"))
    dims = X.dim_routes(spark, sf_dir), X.dim_vehicles(spark, sf_dir)
    result = run_batch(rows, *dims, store, sink, "run_a", X.AFTER_LAST, f"{root}/bad", f"{root}/runs")
    made = len(names_in(spark, f"{root}/gold"))
    bad = spark.createDataFrame(list(result.bad_counts.items()), f"{S.REASON_COLUMN} string, bad_rows long")
    return bad.select("*", F.lit(made).alias("gold_entries"), F.lit(result.clean_count).cast("long").alias("clean_rows"))


def csv_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in a folder for each status; each row names the folder that it was read from."""
    root = scratch_path(spark, "lineage")
    for status in (S.STATUS_COMPLETED, S.STATUS_IN_PROGRESS, "cancelled"):
        X.land_csv(spark, sf_dir, f"{root}/{status}", 2, status)
    rows = read_trips_csv(spark, root)
    return rows.select("trip_id", F.element_at(F.split(S.LINEAGE_COLUMN, "/"), -2).alias("folder"))


def discovered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read with the columns and types that were found in them."""
    folder = scratch_path(spark, "discovered")
    X.land_csv(spark, sf_dir, folder)
    rows = read_trips_csv(spark, folder, discover_csv_schema(spark, folder))
    rows = rows.where(F.col(S.CORRUPT_COLUMN).isNull())
    return rows.select("trip_id", "route_id", "distance_km", F.typeof("distance_km").alias("distance_type"))


def mixed_headers_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three headers, each column found by its name."""
    folder = scratch_path(spark, "mixed")
    X.land_mixed_csv(spark, sf_dir, folder)
    rows = read_trips_by_name(spark, folder)
    whole = F.col(S.CORRUPT_COLUMN).isNull()
    names = ("vehicle_id", "route_id", "distance_km", "status", "vehicle_id_raw")
    return rows.select(*(F.when(whole, F.col(c)).alias(c) for c in ("trip_id", *names)), (~whole).alias("is_corrupt"))


def dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vehicles written as CSV, some twice, and read as a lookup."""
    folder = scratch_path(spark, "vehicles")
    vehicles = X.dim_vehicles(spark, sf_dir)
    again = vehicles.where(F.substring("vehicle_id", -1, 1) == "7").withColumn("capacity", F.col("capacity") + 500)
    vehicles.unionByName(again).write.option("header", "true").csv(folder)
    return read_dimension(spark, folder, vehicles.schema, "vehicle_id")


def queries() -> dict[str, Query]:
    return {
        "daily_ridership": daily_ridership,
        "daily_ridership_minutes": daily_ridership_minutes,
        "hourly_counts": hourly_counts,
        "peak_hour": peak_hour,
        "weekly_rolling_counts": weekly_rolling_counts,
        "weekly_top_routes": weekly_top_routes,
        "top_routes_last_week": top_routes_last_week,
        "date_spine": spine,
        "trip_outliers_run": trip_outliers_run,
        "trip_outliers_dates": trip_outliers_dates,
        "trip_outliers_day": trip_outliers_day,
        "route_duration_stats": route_duration_stats,
        "zscores": zscores,
        "enrich_trips": enriched,
        "load_window": load_window,
        "normalize_trips": normalize_trips,
        "classify_reasons": classify_reasons,
        "quarantine_by_reason": quarantine_by_reason,
        "clean_trips": clean_trips,
        "semi_routes": semi_routes,
        "anti_routes": anti_routes,
        "anti_vehicles": anti_vehicles,
        "dedupe_batch": dedupe_batch,
        "latest_per_trip": latest_per_trip,
        "merge_strict": merge_strict,
        "merge_open": merge_open,
        "merge_small_batch": merge_small_batch,
        "replace_date_range": replace_date_range,
        "latest_daily": latest_daily,
        "latest_top_routes": latest_top_routes,
        "worst_outliers": worst_outliers,
        "batch_metrics": batch_metrics,
        "from_csv_corrupt": from_csv_corrupt,
        "csv_scan": csv_scan,
        "distinct_paths": announced_paths,
        "quarantine_roundtrip": quarantine_roundtrip,
        "run_metadata": run_metadata,
        "branch_read": branch_read,
        "branch_publish": branch_publish,
        "two_staged_runs": two_staged_runs,
        "restaged_branch": restaged_branch,
        "branch_audit": branch_audit,
        "gold_replace": gold_replace,
        "stream_batches": stream_batches,
        "stream_late_files": stream_late_files,
        "stream_replay": stream_replay,
        "run_gold_daily": run_gold_daily,
        "run_gold_weekly": run_gold_weekly,
        "run_gold_outliers": run_gold_outliers,
        "gold_skipped": gold_skipped,
        "csv_lineage": csv_lineage,
        "discovered_scan": discovered_scan,
        "mixed_headers_scan": mixed_headers_scan,
        "dimension_scan": dimension_scan,
    }
