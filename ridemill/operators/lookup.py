"""Joins of trips with small lookups, and the size check that allows a broadcast.

A lookup is measured once, where it is read (`sized`); the broadcast hint then
travels with the DataFrame.  A lookup over the limit carries no hint: Spark
joins it by shuffle, and AQE splits a hot key of the trip side, which it can do
for inner, left outer, semi and anti joins alike.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemill.session import checkpointed

BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
#: Rows of the vehicles that a row of `folded_vehicles` stands for.
COPIES = "_vehicle_copies"
_ROW_OVERHEAD_BYTES = 32


def row_floor_bytes(df: DataFrame) -> int:
    """Size of a row with empty texts."""
    return _ROW_OVERHEAD_BYTES + 8 * len(df.columns)


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of the rows, counted by one aggregate over them.

    A nested value counts 8 bytes for each byte of its JSON text, nulls and names
    included: more than it can take.
    """
    per_row = [F.lit(row_floor_bytes(df)).cast("bigint")]
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            per_row.append(F.coalesce(F.octet_length(column).cast("bigint"), F.lit(0)))
        elif isinstance(field.dataType, T.DecimalType):
            per_row.append(F.lit(16).cast("bigint"))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            text = F.to_json(F.struct(column), {"ignoreNullFields": "false"})
            per_row.append(F.octet_length(text).cast("bigint") * 8)
    return df.agg(F.coalesce(F.sum(reduce(add, per_row)), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return measured_bytes(df) <= limit


def sized(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """`df`, hinted for broadcast if its measured size allows it."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def unique_lookup(df: DataFrame, key: str, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """One row per key, the first in column order, without null keys; hinted if small.

    A large lookup is written once, so that joins read it by a plain shuffle.
    """
    window = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in df.columns])
    numbered = df.where(F.col(key).isNotNull()).withColumn("_rn", F.row_number().over(window))
    rows = numbered.where("_rn = 1").drop("_rn")
    return F.broadcast(rows) if fits_broadcast(df, limit) else checkpointed(rows)


def known_keys(trips: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Trips whose key is in the dimension."""
    return trips.join(dimension.select(key), key, "left_semi")


def unknown_keys(trips: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Trips whose key is null or not in the dimension."""
    return trips.join(dimension.select(key), key, "left_anti")


def with_dimension(trips: DataFrame, dimension: DataFrame, key: str, *attributes: str) -> DataFrame:
    """Inner join that adds the named attributes after the trip columns."""
    joined = trips.join(dimension.select(key, *attributes), key, "inner")
    return joined.select(*trips.columns, *attributes)


def folded_vehicles(vehicles: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """One row per vehicle and type: COPIES, the sum and the number of their capacities; hinted if small.

    A join with it has a row for each type of a trip's vehicle, however often the vehicle is listed;
    `day_sums` and `trip_outliers` count such a row COPIES times.
    """
    sums = (F.count(F.lit(1)).alias(COPIES), F.sum("capacity").alias("capacity_sum"), F.count("capacity").alias("capacity_n"))
    rows = vehicles.groupBy("vehicle_id", "vehicle_type").agg(*sums)
    return F.broadcast(rows) if fits_broadcast(rows, limit) else checkpointed(rows)


def enrich_trips(trips: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Trips of known vehicles, with vehicle type and capacity, or what `folded_vehicles` has in its place."""
    attributes = (COPIES, "capacity_sum", "capacity_n") if COPIES in vehicles.columns else ("capacity",)
    return with_dimension(trips, vehicles, "vehicle_id", "vehicle_type", *attributes)
