"""Trips that took far longer than their route usually does, or went too far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.functions import (
    between_days,
    duration_minutes,
    duration_us,
    mean_minutes,
    shift_day,
    split_seconds,
    whole_minutes,
    zscore,
)
from ridemill.functions.columns import MICROS_PER_MINUTE
from ridemill.operators.lookup import COPIES, enrich_trips, sized
from ridemill.session import checkpointed

STATS_KEY = ["route_id", "vehicle_type"]


def finished(trips: DataFrame) -> DataFrame:
    return trips.where((F.col("status") == S.STATUS_COMPLETED) & F.col("end_time").isNotNull())


def route_duration_stats(trips: DataFrame, duration: str = "exact") -> DataFrame:
    """Mean and sample deviation of finished trips per route and vehicle type."""
    if duration == "exact":
        seconds, micros = split_seconds(duration_us())
        n = F.count(F.lit(1))
        mean = mean_minutes(F.sum(seconds), F.sum(micros), n)
        spread = F.stddev_samp(duration_minutes())
    else:
        mean, spread = F.avg(whole_minutes()), F.stddev_samp(whole_minutes())
    return (
        finished(trips)
        .groupBy(*STATS_KEY)
        .agg(mean.alias("avg_duration_minutes"), spread.alias("stddev_duration_minutes"))
    )


def fold_duration_stats(sums: DataFrame) -> DataFrame:
    """The same statistics from kept moments (`day_sums`), added up over the days.

    The moments are whole numbers, so the deviation is the same however the trips were dealt to
    days.  Squares are taken from the whole part of the mean, in 38 digits: nothing cancels out.
    """
    total, n = F.col("finished_sum"), F.col("finished_n")
    sums = sums.where("finished_n > 0").groupBy(*STATS_KEY)
    sums = sums.agg(*[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("finished_n", "finished_sum", "finished_squares")])
    whole = F.call_function("div", total, n)
    sums = sums.withColumn("whole", whole.cast("decimal(19,0)")).withColumn("rest", (total - F.col("whole") * n).cast("double"))
    around = F.col("finished_squares") - F.col("whole") * (total + total) + F.col("whole") * F.col("whole") * n
    count = n.cast("double")
    variance = (around.cast("double") - F.col("rest") * F.col("rest") / count) / (count - 1)
    seconds, micros = split_seconds(total)
    return sums.select(
        *STATS_KEY,
        mean_minutes(seconds.cast("long"), micros.cast("long"), n.cast("long")).alias("avg_duration_minutes"),
        F.when(n > 1, F.sqrt(variance) / F.lit(float(MICROS_PER_MINUTE))).alias("stddev_duration_minutes"),
    )


def run_scope(run_id: str, start, end) -> Column:
    """The trips to judge: those of one run, or for `main` those of the dates."""
    if run_id == "main":
        return between_days(F.col("start_time"), start, end)
    return F.col(S.RUN_COLUMN) == run_id


def score_trips(trips: DataFrame, scope: Column, duration: str = "exact", stats: DataFrame | None = None) -> DataFrame:
    """Finished trips in scope with their route's statistics and z-score.

    Without `stats` the baseline is all finished trips of `trips`.  Its statistics
    are one row per route and vehicle type; they are written once, measured, and
    broadcast if small, so that the judged trips need no shuffle on a hot route.
    That runs two jobs while the plan is built and leaves a checkpoint; callers that
    must not, or that judge fewer trips than the baseline has, give `stats`.  Trips joined with
    `folded_vehicles` need `stats` and keep their COPIES.
    """
    folded = [COPIES] if COPIES in trips.columns else []
    if stats is None:
        if folded:
            raise ValueError("trips joined with folded vehicles are judged by given stats only")
        stats = sized(checkpointed(route_duration_stats(trips, duration)))
    length = duration_minutes() if duration == "exact" else whole_minutes()
    judged = finished(trips).where(scope).select(
        "trip_id",
        "route_id",
        "vehicle_id",
        "vehicle_type",
        "start_time",
        "end_time",
        "distance_km",
        length.alias("duration_minutes"),
        *folded,
    )
    spread = F.coalesce("stddev_duration_minutes", F.lit(0.0))
    return (
        judged.join(stats, STATS_KEY, "left")
        .withColumn("stddev_duration_minutes", spread)
        .withColumn(
            "z_score",
            zscore(F.col("duration_minutes"), F.col("avg_duration_minutes"), F.col("stddev_duration_minutes")),
        )
    )


def trip_outliers(
    trips: DataFrame,
    scope: Column,
    z: float = 3.0,
    max_km: float = 80.0,
    duration: str = "exact",
    otherwise: str | None = S.OUTLIER_NONE,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Scored trips above `z` or `max_km`; the duration reason goes first.

    Of trips joined with `folded_vehicles` an outlier has a row for each of its COPIES.
    """
    too_long, too_far = F.col("z_score") > z, F.col("distance_km") > max_km
    reason = F.when(too_long, S.OUTLIER_DURATION).when(too_far, S.OUTLIER_DISTANCE).otherwise(F.lit(otherwise))
    found = score_trips(trips, scope, duration, stats).where(too_long | too_far).withColumn("outlier_reason", reason)
    if COPIES in found.columns:
        found = found.withColumn(COPIES, F.explode(F.sequence(F.lit(1).cast("long"), COPIES)))
    return found.select(*S.GOLD_OUTLIERS.column_names)


def trip_outliers_on(trips: DataFrame, vehicles: DataFrame, day, lookback_days: int = 7, **limits) -> DataFrame:
    """Outliers of one day against that day and the `lookback_days` before, in whole minutes."""
    recent = trips.where(between_days(F.col("start_time"), shift_day(day, -lookback_days), day))
    enriched = enrich_trips(recent, vehicles)
    scope = between_days(F.col("start_time"), day, day)
    return trip_outliers(enriched, scope, duration="minutes", otherwise=None, **limits)
