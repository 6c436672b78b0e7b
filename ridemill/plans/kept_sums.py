"""Sums by day, kept from run to run under the version of the day they were made from.

    <root>/day_sums/version=<version of the day>-<mark of the vehicles>/

A day's version changes with its rows, so kept sums are never stale: a day that a run
has touched has no sums under its new version and is summed anew, the others are read.
The mark changes with the vehicles, whose types are part of the sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemill.operators.ridership import day_sums
from ridemill.session import names_in

_VERSION = "version"


def kept_day_sums(
    store,
    branch: str,
    days: Iterable[dt.date],
    vehicles: DataFrame,
    trips_of: Callable[[list[dt.date]], DataFrame],
) -> DataFrame:
    """The `day_sums` of the days as a branch sees them; `trips_of` gives the joined trips of those that are summed anew.

    A store that cannot tell versions has all its days summed.
    """
    days = list(days)
    versions = store.versions(branch, days)
    if versions is None:
        return day_sums(trips_of(days))
    spark, root, mark = vehicles.sparkSession, store.sums_root, vehicles_mark(vehicles)
    names = {day: f"{version}-{mark}" for day, version in versions.items()}
    kept = names_in(spark, root)
    missing = [day for day, name in names.items() if f"{_VERSION}={name}" not in kept]
    fresh = day_sums(trips_of(missing or days[:1]))
    if missing:
        # About a month of days at most, by the time check of the batch and the padding.
        named = reduce(lambda so_far, day: so_far.when(F.col("trip_date") == F.lit(day), names[day]), missing, F.when(F.lit(False), ""))
        by_version = fresh.withColumn(_VERSION, named).where(F.col(_VERSION).isNotNull())
        shaped = by_version.repartition(_VERSION).sortWithinPartitions("per_vehicle", "route_id")
        shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_VERSION).parquet(root)
        kept = names_in(spark, root)
    # A day whose trips all lack a vehicle has no sums.
    paths = [f"{root}/{_VERSION}={name}" for name in sorted(names.values()) if f"{_VERSION}={name}" in kept]
    if not paths:
        return spark.createDataFrame([], fresh.schema)
    return spark.read.schema(fresh.schema).parquet(*paths)


def vehicles_mark(vehicles: DataFrame) -> str:
    """A mark of the vehicles' rows, in any order."""
    row = F.xxhash64("vehicle_id", "vehicle_type", "capacity")
    found = vehicles.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).alias("total")).first()
    return f"{found['n']}-{int(found['total']) % (1 << 64):016x}"
