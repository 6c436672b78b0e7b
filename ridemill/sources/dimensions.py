"""Small lookup tables, measured when read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridemill.operators.lookup import BROADCAST_LIMIT_BYTES, sized, unique_lookup


def read_dimension(
    spark: SparkSession,
    source: str,
    schema: T.StructType | None = None,
    key: str | None = None,
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """A CSV folder or file (with `schema`), a Parquet path, or a catalog table.

    With `key` the result has one row per key.  It is hinted for broadcast if
    the source measures at most `limit` bytes.
    """
    if schema is not None:
        rows = spark.read.schema(schema).option("header", "true").csv(source)
    elif "/" in source:
        rows = spark.read.parquet(source)
    else:
        rows = spark.table(source)
    return sized(rows, limit) if key is None else unique_lookup(rows, key, limit)
