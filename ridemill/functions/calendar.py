"""Day arithmetic: literals, ranges, a day series and rolling windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Day = dt.date | str


def as_day(value: Day | dt.datetime) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def shift_day(value: Day, days: int) -> dt.date:
    return as_day(value) + dt.timedelta(days=days)


def day_literal(value: Day) -> Column:
    return F.lit(as_day(value).isoformat()).cast("date")


def between_days(column: Column, start: Day, end: Day) -> Column:
    """`start` <= day <= `end` for a timestamp column, as a half-open range.

    Written as plain comparisons so that it reaches the Parquet scan, and the
    last second of `end` is included to its last fraction.
    """
    return (column >= day_literal(start)) & (column < day_literal(shift_day(end, 1)))


def date_spine(spark: SparkSession, start: Day, end: Day, name: str = "calculation_date") -> DataFrame:
    """One row per day from `start` to `end`."""
    days = F.sequence(day_literal(start), day_literal(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))


def rolling_window_expand(
    df: DataFrame,
    date_col: str,
    days: int,
    start: Day,
    end: Day,
    name: str = "calculation_date",
) -> DataFrame:
    """Copy each row to every calculation date whose trailing window holds it.

    A row of day d belongs to the windows of d .. d+days-1, clipped to
    [start, end].  Meant for pre-aggregated rows: the copies then number
    `days` per (day, key), not per fact.
    """
    day = F.col(date_col)
    first = F.greatest(day, day_literal(start))
    last = F.least(F.date_add(day, days - 1), day_literal(end))
    in_reach = df.where((day >= day_literal(shift_day(start, 1 - days))) & (day <= day_literal(end)))
    return in_reach.withColumn(name, F.explode(F.sequence(first, last)))
