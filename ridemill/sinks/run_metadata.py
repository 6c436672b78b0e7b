"""One JSON object per run: its id and the first and last date it touched."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.session import path_exists


def write_run_metadata(spark: SparkSession, root: str, run_id: str, start_date: str | None, end_date: str | None) -> None:
    """Always written; the dates are null if the run had no clean row."""
    row = spark.range(1, numPartitions=1).select(
        F.lit(run_id).alias(S.RUN_COLUMN),
        F.lit(start_date).cast("string").alias("start_date"),
        F.lit(end_date).cast("string").alias("end_date"),
    )
    row.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root}/{run_id}")


def first_attempt_time(spark: SparkSession, root: str, run_id: str) -> str:
    """The time at which a run was first tried, noted at that moment.

    A repeated run judges its rows by the same time, and so comes out the same.
    """
    folder = f"{root}/first_attempt/{run_id}"
    if not path_exists(spark, f"{folder}/_SUCCESS"):
        now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        spark.range(1, numPartitions=1).select(F.lit(now).alias("as_of")).write.mode("overwrite").json(folder)
    return spark.read.schema("as_of string").json(folder).first()["as_of"]


def read_run_metadata(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.schema(S.RUN_METADATA).json(f"{root}/{run_id}")
