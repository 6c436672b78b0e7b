"""Daily ridership and its parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.functions import (
    between_days,
    day_literal,
    duration_us,
    mean_minutes,
    shift_day,
    split_seconds,
    status_count,
    whole_minutes,
)
from ridemill.functions.columns import MICROS_PER_MINUTE
from ridemill.operators.lookup import COPIES

GROUP = ["trip_date", "route_id", "vehicle_type"]


def load_window(trips: DataFrame, start, end, pad_days: int = 6) -> DataFrame:
    """Trips of [start - pad, end + pad]; prunes day partitions where there are any."""
    first, last = shift_day(start, -pad_days), shift_day(end, pad_days)
    window = trips.where(between_days(F.col("start_time"), first, last))
    if S.DAY_COLUMN in trips.columns:
        window = window.where(F.col(S.DAY_COLUMN).between(day_literal(first), day_literal(last)))
    return window


def hourly_counts(trips: DataFrame, start, end) -> DataFrame:
    """Trips per day, route, vehicle type and hour."""
    return (
        trips.where(between_days(F.col("start_time"), start, end))
        .groupBy(
            F.to_date("start_time").alias("trip_date"),
            "route_id",
            "vehicle_type",
            F.hour("start_time").alias("trip_hour"),
        )
        .agg(F.count("trip_id").alias("hour_trip_count"))
    )


def peak_hours(hourly: DataFrame) -> DataFrame:
    """The busiest hour of each day, route and vehicle type; the earlier one on a tie."""
    return hourly.groupBy(*GROUP).agg(
        _busiest_hour(F.col("trip_hour"), F.col("hour_trip_count")).alias("peak_hour")
    )


def daily_ridership(trips: DataFrame, start, end, duration: str = "exact") -> DataFrame:
    """Ten measures per day, route and vehicle type over [start, end].

    One scan and two shuffles.  Grouping sets pre-aggregate each trip once by
    hour (measures, hour counts) and once by vehicle (distinct vehicles), which
    also cuts a hot route into hours and vehicles before rows move; the second
    aggregate folds those few rows.  Groups with a null key are left out.
    `duration="minutes"` counts complete minutes.
    """
    if duration not in ("exact", "minutes"):
        raise ValueError(f"duration must be 'exact' or 'minutes', not {duration!r}")
    keyed = trips.where(
        between_days(F.col("start_time"), start, end)
        & F.col("route_id").isNotNull()
        & F.col("vehicle_type").isNotNull()
    )
    length = duration_us() if duration == "exact" else whole_minutes()
    facts = keyed.select(
        F.to_date("start_time").alias("trip_date"),
        "route_id",
        "vehicle_type",
        F.hour("start_time").alias("trip_hour"),
        "vehicle_id",
        "trip_id",
        "status",
        "capacity",
        length.alias("length"),
    )
    return fold_daily(_partial(facts, duration, []), duration)


def _partial(facts: DataFrame, duration: str, more: list[Column]) -> DataFrame:
    """Sums by hour, and by vehicle where `per_vehicle` is 1, in one scan; `more` sums are for the hours.

    A row with COPIES counts that often.
    """
    by_hour, by_vehicle = [*GROUP, "trip_hour"], [*GROUP, "vehicle_id"]
    if COPIES in facts.columns:
        capacity = F.sum("capacity_sum"), F.sum("capacity_n")
        completed, in_progress = (_copies_where(F.col("status") == status) for status in (S.STATUS_COMPLETED, S.STATUS_IN_PROGRESS))
    else:
        capacity = F.sum("capacity"), F.count("capacity")
        completed, in_progress = status_count(S.STATUS_COMPLETED), status_count(S.STATUS_IN_PROGRESS)
    return facts.groupingSets([by_hour, by_vehicle], *GROUP, "trip_hour", "vehicle_id").agg(
        F.grouping("trip_hour").alias("per_vehicle"),
        _number(facts, "trip_id").alias("trips"),
        capacity[0].alias("capacity_sum"),
        capacity[1].alias("capacity_n"),
        *_length_sums(facts, duration),
        _number(facts, "length").alias("length_n"),
        F.max("length").alias("length_max"),
        completed.alias("completed"),
        in_progress.alias("in_progress"),
        *more,
    )


def _copies_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col(COPIES)).otherwise(0))


def _number(facts: DataFrame, name: str) -> Column:
    """How many values a column has, each as often as its row counts."""
    return _copies_where(F.col(name).isNotNull()) if COPIES in facts.columns else F.count(name)


def _each(facts: DataFrame, value: Column, dtype: str = "bigint") -> Column:
    """`value` times the number its row counts."""
    return value * F.col(COPIES).cast(dtype) if COPIES in facts.columns else value


def day_sums(trips: DataFrame) -> DataFrame:
    """What the business tables need of whole days, to be kept: sums by day, route, vehicle type and hour.

    Rows with `per_vehicle` 1 name the vehicles of a day, route and type.  All sums are of whole
    numbers and all rows of one day, so days can be added up in any way with the same result;
    `finished_*` are the moments of finished trips in microseconds: their number, sum and sum of squares.
    Groups with a null key are kept; `fold_daily` leaves them out.  Trips joined with `folded_vehicles`
    give the sums of those joined with each row of the vehicles.
    """
    length = duration_us()
    capacity = (COPIES, "capacity_sum", "capacity_n") if COPIES in trips.columns else ("capacity",)
    facts = trips.select(
        F.to_date("start_time").alias("trip_date"),
        "route_id",
        "vehicle_type",
        F.hour("start_time").alias("trip_hour"),
        "vehicle_id",
        "trip_id",
        "status",
        *capacity,
        length.alias("length"),
        F.when((F.col("status") == S.STATUS_COMPLETED) & F.col("end_time").isNotNull(), length).alias("finished"),
    )
    us = F.col("finished").cast("decimal(19,0)")
    moments = [
        _number(facts, "finished").alias("finished_n"),
        F.sum(_each(facts, us, "decimal(19,0)")).cast("decimal(38,0)").alias("finished_sum"),
        F.sum(_each(facts, us * us, "decimal(19,0)")).alias("finished_squares"),
    ]
    sums = _partial(facts, "exact", moments)
    keys = {*GROUP, "trip_hour", "vehicle_id", "per_vehicle"}
    # A vehicle's row only says that it was there.
    return sums.select(*[c if c in keys else F.when(F.col("per_vehicle") == 0, F.col(c)).alias(c) for c in sums.columns])


def fold_daily(partial: DataFrame, duration: str = "exact") -> DataFrame:
    """The ten measures from sums by hour and rows by vehicle (`day_sums`)."""
    keyed = partial.where(F.col("route_id").isNotNull() & F.col("vehicle_type").isNotNull())

    def hourly(name: str) -> Column:
        return F.when(F.col("per_vehicle") == 0, F.col(name))

    vehicle_seen = F.when((F.col("per_vehicle") == 1) & F.col("vehicle_id").isNotNull(), 1)
    n = F.sum(hourly("length_n"))
    if duration == "exact":
        mean = mean_minutes(F.sum(hourly("length_seconds")), F.sum(hourly("length_micros")), n)
        longest = F.max("length_max") / F.lit(float(MICROS_PER_MINUTE))
    else:
        mean = F.when(n > 0, F.sum(hourly("length_minutes")) / n)
        longest = F.max("length_max").cast("double")
    return keyed.groupBy(*GROUP).agg(
        F.sum(hourly("trips")).alias("total_trips"),
        F.count(vehicle_seen).alias("unique_vehicles"),
        (F.sum(hourly("capacity_sum")) / F.sum(hourly("capacity_n"))).alias("avg_capacity"),
        mean.alias("avg_duration_minutes"),
        longest.alias("max_duration_minutes"),
        F.sum(hourly("completed")).alias("trips_completed"),
        F.sum(hourly("in_progress")).alias("trips_in_progress"),
        _busiest_hour(hourly("trip_hour"), F.col("trips")).alias("peak_hour"),
    )


def _length_sums(facts: DataFrame, duration: str) -> list[Column]:
    if duration == "minutes":
        return [F.sum(_each(facts, F.col("length"))).alias("length_minutes")]
    seconds, micros = split_seconds(F.col("length"))
    return [F.sum(_each(facts, seconds)).alias("length_seconds"), F.sum(_each(facts, micros)).alias("length_micros")]


def _busiest_hour(hour: Column, trips: Column) -> Column:
    """Hour with most trips, earliest on a tie.

    Count and hour share one long, so the maximum stays in a hash aggregate; a
    struct-valued maximum would need a sort.
    """
    rank = F.max(trips * F.lit(24) + (F.lit(23) - hour))
    return (F.lit(23) - rank % F.lit(24)).cast("int")
