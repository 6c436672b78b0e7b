"""Column helpers; all are built-in expressions and stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_SECOND = 1_000_000
MICROS_PER_MINUTE = 60_000_000


def pad_id(raw: Column, prefix: str, width: int) -> Column:
    """`prefix` plus the text after the first character, padded or cut to `width`.

    Null and '' come through unchanged; the first character is dropped unseen.
    """
    number = F.lpad(F.substring(raw, 2, 10), width, "0")
    return F.when(raw == "", raw).otherwise(F.concat(F.lit(prefix), number))


def blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def parse_timestamp(value: Column, dtype: T.DataType) -> Column:
    """Text becomes a timestamp, or null if unreadable; timestamps pass as they are."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return value
    return F.try_to_timestamp(value.cast("string"))


def duration_us(start: Column | str = "start_time", end: Column | str = "end_time") -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def duration_minutes(start: Column | str = "start_time", end: Column | str = "end_time") -> Column:
    return duration_us(start, end) / F.lit(float(MICROS_PER_MINUTE))


def whole_minutes(start: Column | str = "start_time", end: Column | str = "end_time") -> Column:
    """Complete elapsed minutes."""
    return F.timestamp_diff("MINUTE", _col(start), _col(end))


def split_seconds(micros: Column) -> tuple[Column, Column]:
    """Whole seconds and left-over microseconds, for sums that must not overflow.

    One long of microseconds overflows near 5e9 half-hour trips in a group; the
    two parts reach 1e12 and more.  Integer sums are also the same in any order,
    so a recomputed task cannot change a mean.
    """
    whole = F.call_function("div", micros, F.lit(MICROS_PER_SECOND))
    return whole, micros % F.lit(MICROS_PER_SECOND)


def mean_minutes(sum_seconds: Column, sum_micros: Column, n: Column) -> Column:
    """Mean in minutes from the summed parts; null if nothing was summed."""
    total = sum_seconds + sum_micros / F.lit(float(MICROS_PER_SECOND))
    return F.when(n > 0, total / F.lit(60.0) / n)


def status_count(status: str) -> Column:
    return F.sum(F.when(F.col("status") == status, 1).otherwise(0))


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """Standard score; 0 where the spread is unknown or zero."""
    return F.when(stddev > 0, (value - mean) / stddev).otherwise(F.lit(0.0))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
