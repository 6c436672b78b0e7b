"""The ten newest or worst rows of each business table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_daily(daily: DataFrame, k: int = 10) -> DataFrame:
    shown = daily.select("trip_date", "route_id", "vehicle_type", "total_trips", "peak_hour")
    return shown.orderBy(F.desc("trip_date"), F.desc("total_trips"), "route_id", "vehicle_type").limit(k)


def latest_top_routes(weekly: DataFrame, k: int = 10) -> DataFrame:
    shown = weekly.select(
        "calculation_date", "route_rank", "route_id", "total_trips", "avg_trip_duration_minutes"
    )
    return shown.orderBy(F.desc("calculation_date"), "route_rank", "route_id").limit(k)


def worst_outliers(outliers: DataFrame, k: int = 10) -> DataFrame:
    shown = outliers.select(
        "trip_id", "route_id", "start_time", "duration_minutes", "z_score", "outlier_reason"
    )
    return shown.orderBy(F.desc("z_score"), "trip_id").limit(k)
