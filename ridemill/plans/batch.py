"""The batch jobs: raw rows to trip tables, trip tables to business tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.functions import as_day, day_literal, shift_day
from ridemill.operators.dedupe import dedupe_batch, latest_per_trip
from ridemill.operators.lookup import (
    BROADCAST_LIMIT_BYTES,
    enrich_trips,
    fits_broadcast,
    folded_vehicles,
    row_floor_bytes,
    sized,
    unique_lookup,
)
from ridemill.operators.metrics import observe_reasons
from ridemill.operators.outliers import fold_duration_stats, run_scope, trip_outliers
from ridemill.operators.rankings import fold_weekly
from ridemill.operators.ridership import fold_daily, load_window
from ridemill.operators.validate import classify_trips, quarantine_rows, split_clean_bad
from ridemill.plans.kept_sums import kept_day_sums
from ridemill.plans.parquet_store import ACTIVE, MAIN, distinct_days
from ridemill.session import checkpointed, delete_path, require_utc
from ridemill.sinks.gold_files import GoldWrite
from ridemill.sinks.quarantine import write_quarantine
from ridemill.sinks.run_metadata import write_run_metadata

WINDOW_PAD_DAYS = 6


@dataclass(frozen=True)
class SilverResult:
    run_id: str
    clean_count: int
    start_date: str | None
    end_date: str | None
    bad_counts: dict[str, int]

    @property
    def has_clean_rows(self) -> bool:
        return self.start_date is not None and self.end_date is not None


def run_silver(
    raw: DataFrame,
    routes: DataFrame,
    vehicles: DataFrame,
    store,
    run_id: str,
    as_of: dt.datetime | str,
    quarantine_root: str,
    metadata_root: str,
    null_end: str = "strict",
) -> SilverResult:
    """Validate a batch, quarantine its bad rows and stage its clean rows on the run's branch.

    The raw rows are judged twice, once for each output: keeping them in between
    takes as long as parsing them again, needs room for the whole batch, and can
    be lost with an executor.  Everything after the history write reads the
    staged history.  With run id `main` the result is published at once.  A raw row is
    one row of the outputs, however often the dimensions hold its keys.
    """
    spark = raw.sparkSession
    require_utc(spark)
    known = (unique_lookup(dimension.select(key), key) for dimension, key in ((routes, "route_id"), (vehicles, "vehicle_id")))
    classified = classify_trips(raw, *known, run_id, as_of)
    bad_counts = _quarantine(classified, quarantine_root, run_id)
    clean, _ = split_clean_bad(classified)
    store.init_tables(clean)
    metrics = store.append_history(run_id, dedupe_batch(clean))

    result = SilverResult(run_id, metrics["clean_count"], metrics["start_date"], metrics["end_date"], bad_counts)
    if result.has_clean_rows:
        _merge_batch(store, result, null_end)
        if run_id == MAIN:
            store.publish(run_id)
    write_run_metadata(spark, metadata_root, run_id, result.start_date, result.end_date)
    return result


def _quarantine(classified: DataFrame, root: str, run_id: str) -> dict[str, int]:
    """Write the bad rows, counted on the way; no folder stays if there are none."""
    observed, reasons = observe_reasons(quarantine_rows(classified))
    mode = "append" if run_id == MAIN else "overwrite"
    folder = write_quarantine(observed, root, run_id, mode)
    counts = {reason: n for reason, n in reasons.get.items() if n}
    if not counts and mode == "overwrite":
        delete_path(classified.sparkSession, folder)
    return counts


def _merge_batch(store, result: SilverResult, null_end: str) -> None:
    staged = store.batch_rows(result.run_id)
    # The count alone rules out a large batch, so that only a small one is measured.
    small = result.clean_count * row_floor_bytes(staged) <= BROADCAST_LIMIT_BYTES and fits_broadcast(staged)
    source = latest_per_trip(staged)
    if small:
        source = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        store.merge_active(result.run_id, source, distinct_days(staged), null_end, small)
    finally:
        if small:
            source.unpersist()


def run_gold(
    vehicles: DataFrame,
    store,
    sink,
    run_id: str,
    start_date: str,
    end_date: str,
    persist: bool = False,
) -> None:
    """Recompute the business tables for the touched dates, then publish the branch.

    Daily ridership, the weekly ranking and the outliers' baseline are folded from sums by day
    that are kept from run to run (`kept_day_sums`): of trips, only those of days that have
    changed are read, and those that are judged.  `persist` keeps the joined trips of the dates for
    both.  Trips meet each vehicle once for each of its types and count as often as the table lists it.
    The branch is published only after the sink has taken all three tables, and they
    are made anew if another run has published one of its days meanwhile.
    """
    require_utc(vehicles.sparkSession)
    if run_id == MAIN:
        _write_gold(vehicles, store, sink, run_id, start_date, end_date, persist)
        return
    while True:
        store.rebase(run_id)
        _write_gold(vehicles, store, sink, run_id, start_date, end_date, persist)
        if store.is_current(run_id):
            break
    store.publish(run_id)


def _write_gold(vehicles: DataFrame, store, sink, run_id: str, start_date: str, end_date: str, persist: bool) -> None:
    last_calculation = shift_day(end_date, WINDOW_PAD_DAYS)
    dates, padded = _days(start_date, end_date), _days(shift_day(start_date, -WINDOW_PAD_DAYS), last_calculation)
    folded = folded_vehicles(vehicles)
    of_the_dates = _enriched(store, run_id, folded, dates)
    if persist:
        of_the_dates = of_the_dates.persist(StorageLevel.MEMORY_AND_DISK)

    def trips_of(days: list[dt.date]) -> DataFrame:
        return of_the_dates.where(F.to_date("start_time").isin(days)) if persist and set(days) <= set(dates) else _enriched(store, run_id, folded, days)

    try:
        sums = kept_day_sums(store, run_id, padded, vehicles, trips_of)
        daily = fold_daily(sums.where(F.col("trip_date").between(day_literal(start_date), day_literal(end_date))))
        weekly = fold_weekly(sums, start_date, last_calculation)
        stats = sized(checkpointed(fold_duration_stats(sums)))
        outliers = trip_outliers(of_the_dates, run_scope(run_id, start_date, end_date), stats=stats)
        sink.replace(
            [
                GoldWrite(S.GOLD_DAILY, daily, start_date, end_date),
                GoldWrite(S.GOLD_WEEKLY, weekly, start_date, last_calculation),
                GoldWrite(S.GOLD_OUTLIERS, outliers, start_date, end_date),
            ]
        )
    finally:
        if persist:
            of_the_dates.unpersist()


def _days(first: dt.date | str, last: dt.date | str) -> list[dt.date]:
    first, last = as_day(first), as_day(last)
    return [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]


def _enriched(store, branch: str, vehicles: DataFrame, days: list[dt.date]) -> DataFrame:
    """Trips of the days, joined with their folded vehicles."""
    window = load_window(store.read(ACTIVE, branch, days), min(days), max(days), 0)
    return enrich_trips(window.select(*[c for c in S.ENRICHED_COLUMNS if c not in ("vehicle_type", "capacity")]), vehicles)


def run_batch(
    raw: DataFrame,
    routes: DataFrame,
    vehicles: DataFrame,
    store,
    sink,
    run_id: str,
    as_of: dt.datetime | str,
    quarantine_root: str,
    metadata_root: str,
    null_end: str = "strict",
) -> SilverResult:
    """Silver, then gold for the dates it touched; a batch without clean rows ends after silver."""
    result = run_silver(raw, routes, vehicles, store, run_id, as_of, quarantine_root, metadata_root, null_end)
    if result.has_clean_rows:
        run_gold(vehicles, store, sink, run_id, result.start_date, result.end_date)
    return result
