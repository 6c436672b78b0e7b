"""Keep one row per key, with a total order so that a rerun keeps the same row.

Both are `row_number() = 1` filters, which Spark runs as a group limit before
the shuffle: each task sends at most one row per key, so a trip that fills a
third of the batch arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridemill import schema as S

EXACT_KEY = ("trip_id", "route_id", "vehicle_id", "start_time", "end_time")


def dedupe_batch(clean: DataFrame) -> DataFrame:
    """One row per trip, route, vehicle, start and end."""
    order = [_completed_first(), F.col("distance_km").desc_nulls_last()]
    return _first_row(clean, list(EXACT_KEY), order, decided={"distance_km"})


def latest_per_trip(clean: DataFrame) -> DataFrame:
    """One row per trip: completed before others, then the latest end."""
    order = [
        _completed_first(),
        F.col("end_time").desc_nulls_last(),
        F.col("start_time").desc_nulls_last(),
        F.col("distance_km").desc_nulls_last(),
    ]
    return _first_row(clean, ["trip_id"], order, decided={"end_time", "start_time", "distance_km"})


def _completed_first() -> Column:
    return F.col("status").eqNullSafe(S.STATUS_COMPLETED).desc()


def _first_row(df: DataFrame, key: list[str], order: list[Column], decided: set[str]) -> DataFrame:
    ties = [F.col(c).asc_nulls_last() for c in df.columns if c not in decided and c not in key]
    window = Window.partitionBy(*key).orderBy(*order, *ties)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
