"""Upsert of trips and replacement of a date range, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemill import schema as S
from ridemill.functions import day_literal, shift_day

MERGE_KEY = ["trip_id", "start_time"]


def merge_trips(
    target: DataFrame,
    source: DataFrame,
    null_end: str = "strict",
    source_fits_broadcast: bool = False,
) -> DataFrame:
    """Target after the upsert of source on (trip_id, start_time).

    A matched row is replaced if the source ends no earlier and does not take
    back a completed trip.  A null end makes that comparison unknown, so with
    `null_end="strict"` such a pair is left as it is; with "open" a target
    without an end gives way to any source.  Source rows without a match are
    added.  `source` must hold one row per key (`latest_per_trip`).

    With `source_fits_broadcast` the target is not shuffled: a small batch is
    sent to the target partitions, and only the keys it matched come back.
    """
    if null_end not in ("strict", "open"):
        raise ValueError(f"null_end must be 'strict' or 'open', not {null_end!r}")
    if set(target.columns) != set(source.columns):
        raise ValueError(f"columns differ: {sorted(target.columns)} and {sorted(source.columns)}")
    values = [c for c in target.columns if c not in MERGE_KEY]
    old = target.select(*MERGE_KEY, F.struct(*values).alias("old"))
    new = source.select(*MERGE_KEY, F.struct(*values).alias("new"))
    if source_fits_broadcast:
        kept = old.join(F.broadcast(new), MERGE_KEY, "left")
        seen = target.select(*MERGE_KEY).join(F.broadcast(source.select(*MERGE_KEY)), MERGE_KEY, "left_semi")
        merged = _choose(kept, target.columns, null_end)
        return merged.unionByName(source.join(seen, MERGE_KEY, "left_anti"))
    return _choose(old.join(new, MERGE_KEY, "full_outer"), target.columns, null_end)


def replace_date_range(existing: DataFrame, new: DataFrame, column: str, start, end) -> DataFrame:
    """Existing rows dated outside [start, end], and all new rows."""
    dated = F.col(column)
    outside = (dated < day_literal(start)) | (dated >= day_literal(shift_day(end, 1))) | dated.isNull()
    return existing.where(outside).unionByName(new)


def _choose(pairs: DataFrame, columns: list[str], null_end: str) -> DataFrame:
    wins = F.col("old").isNull() | F.coalesce(_newer(null_end), F.lit(False))
    picked = pairs.select(*MERGE_KEY, F.when(wins, F.col("new")).otherwise(F.col("old")).alias("row"))
    return picked.select(*[F.col(c) if c in MERGE_KEY else F.col(f"row.{c}").alias(c) for c in columns])


def _newer(null_end: str) -> Column:
    ends_later = F.col("new.end_time") >= F.col("old.end_time")
    if null_end == "open":
        ends_later = F.col("old.end_time").isNull() | ends_later
    keeps_completion = (F.col("old.status") != S.STATUS_COMPLETED) | (F.col("new.status") == S.STATUS_COMPLETED)
    return F.col("new").isNotNull() & ends_later & keeps_completion
