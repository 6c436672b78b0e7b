"""Route rankings over seven days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.functions import (
    between_days,
    day_literal,
    duration_us,
    mean_minutes,
    rolling_window_expand,
    shift_day,
    split_seconds,
    status_count,
    whole_minutes,
)


def weekly_rolling_counts(trips: DataFrame, calc_start, calc_end, days: int = 7) -> DataFrame:
    """Totals per route for every calculation date, over the `days` days that end on it.

    Trips are first summed per (day, route); only those sums are copied to the
    windows they belong to.  So no trip meets a range condition, and a hot route
    is one row per task and day before the shuffle.
    """
    in_reach = trips.where(between_days(F.col("start_time"), shift_day(calc_start, 1 - days), calc_end))
    length = duration_us()
    seconds, micros = split_seconds(length)
    per_day = in_reach.groupBy(F.to_date("start_time").alias("day"), "route_id").agg(
        F.count("trip_id").alias("trips"),
        status_count(S.STATUS_COMPLETED).alias("completed"),
        F.sum(seconds).alias("length_seconds"),
        F.sum(micros).alias("length_micros"),
        F.count(length).alias("length_n"),
    )
    return _rolled(per_day, calc_start, calc_end, days)


def _rolled(per_day: DataFrame, calc_start, calc_end, days: int) -> DataFrame:
    windows = rolling_window_expand(per_day, "day", days, calc_start, calc_end)
    mean = mean_minutes(F.sum("length_seconds"), F.sum("length_micros"), F.sum("length_n"))
    return windows.groupBy("calculation_date", "route_id").agg(
        F.sum("trips").alias("total_trips"),
        F.sum("completed").alias("total_completed_trips"),
        mean.alias("avg_trip_duration_minutes"),
    )


def weekly_top_routes(trips: DataFrame, calc_start, calc_end, days: int = 7, k: int = 10) -> DataFrame:
    """The `k` busiest routes of each calculation date's trailing window."""
    return _ranked(weekly_rolling_counts(trips, calc_start, calc_end, days), k)


def fold_weekly(sums: DataFrame, calc_start, calc_end, days: int = 7, k: int = 10) -> DataFrame:
    """The same ranking from kept sums (`day_sums`) instead of trips."""
    per_day = sums.where("per_vehicle = 0").groupBy(F.col("trip_date").alias("day"), "route_id")
    per_day = per_day.agg(*[F.sum(c).alias(c) for c in ("trips", "completed", "length_seconds", "length_micros", "length_n")])
    return _ranked(_rolled(per_day, calc_start, calc_end, days), k)


def _ranked(totals: DataFrame, k: int) -> DataFrame:
    busiest = Window.partitionBy("calculation_date").orderBy(*_by_volume())
    ranked = totals.withColumn("route_rank", F.dense_rank().over(busiest)).where(F.col("route_rank") <= k)
    return ranked.select(*S.GOLD_WEEKLY.column_names)


def top_routes_last_week(trips: DataFrame, as_of, days: int = 7, k: int = 10) -> DataFrame:
    """The `k` busiest routes since `days` before `as_of`; no upper bound, whole minutes."""
    recent = trips.where(F.col("start_time") >= day_literal(shift_day(as_of, -days)))
    totals = recent.groupBy("route_id").agg(
        F.count("trip_id").alias("total_trips"),
        status_count(S.STATUS_COMPLETED).alias("total_completed_trips"),
        F.round(F.avg(whole_minutes()), 1).alias("avg_trip_duration_minutes"),
    )
    # The limit is the report's own size, so the unpartitioned window sees k rows.
    top = totals.orderBy(*_by_volume()).limit(k)
    ranked = top.withColumn("route_rank", F.dense_rank().over(Window.orderBy(*_by_volume())))
    return ranked.select(
        "route_rank", "route_id", "total_trips", "total_completed_trips", "avg_trip_duration_minutes"
    )


def _by_volume() -> list[Column]:
    return [F.col("total_trips").desc(), F.col("route_id").asc()]
