"""Normalisation and validation of raw trips in one pass.

Each raw row gets at most one quarantine reason, from a single CASE over the
normalised columns and two lookup markers; clean rows have none.  The checks are
ordered: corrupt line, missing key, start time out of range, unknown route,
unknown vehicle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemill import schema as S
from ridemill.functions import blank, pad_id, parse_timestamp

_MARK_ROUTE = "_route_known"
_MARK_VEHICLE = "_vehicle_known"
_DROPPED_FROM_SILVER = {"vehicle_id_raw", S.CORRUPT_COLUMN, S.REASON_COLUMN, S.LINEAGE_COLUMN}


def normalize_trips(raw: DataFrame, run_id: str, as_of: dt.datetime | str) -> DataFrame:
    """Silver columns in their fixed order, then any further raw columns."""
    standard = _standard_columns(raw, run_id, as_of)
    return raw.select(*_in_silver_order(standard), *_extra_columns(raw))


def classify_trips(
    raw: DataFrame,
    routes: DataFrame,
    vehicles: DataFrame,
    run_id: str,
    as_of: dt.datetime | str,
    max_age_days: int = 30,
    future_days: int = 1,
) -> DataFrame:
    """Normalised rows with `quarantine_reason`, null for clean rows.

    Corrupt rows keep the raw text of what the parser could read and have no
    audit values.  The other raw-only columns stay until `split_clean_bad`.
    The dimensions need one row per key, which `read_dimension(key=...)` gives:
    an aggregate here would stand between the join and its shuffle, and AQE
    splits a hot route only where the join reads the shuffle directly.
    """
    raw = _with_corrupt_column(raw)
    corrupt = F.col(S.CORRUPT_COLUMN).isNotNull()
    standard = _standard_columns(raw, run_id, as_of)
    for name in ("trip_id", "route_id", "vehicle_id", "status"):
        standard[name] = F.when(corrupt, F.col(name)).otherwise(standard[name])
    for name in ("ingested_at", S.RUN_COLUMN):
        standard[name] = F.when(~corrupt, standard[name])

    carried = [S.CORRUPT_COLUMN]
    if S.LINEAGE_COLUMN in raw.columns:
        carried.append(S.LINEAGE_COLUMN)
    kept = [F.col(c) for c in carried]
    if "vehicle_id_raw" in raw.columns:
        kept.append(F.when(corrupt, F.col("vehicle_id_raw")).alias("vehicle_id_raw"))
    rows = raw.select(*_in_silver_order(standard), *_extra_columns(raw), *kept)
    columns = rows.columns

    marked = rows.join(_marker(routes, "route_id", _MARK_ROUTE), "route_id", "left").join(
        _marker(vehicles, "vehicle_id", _MARK_VEHICLE), "vehicle_id", "left"
    )
    earliest, latest = time_bounds(as_of, max_age_days, future_days)
    start = F.col("start_time")
    start_type = rows.schema["start_time"].dataType
    missing_key = blank(F.col("trip_id")) | blank(F.col("route_id")) | blank(F.col("vehicle_id"))
    out_of_range = (
        start.isNull()
        | (start < F.lit(earliest).cast(start_type))
        | (start > F.lit(latest).cast(start_type))
    )
    reason = (
        F.when(corrupt, S.REASON_CORRUPT)
        .when(missing_key, S.REASON_MISSING_KEY)
        .when(out_of_range, S.REASON_TEMPORAL)
        .when(F.col(_MARK_ROUTE).isNull(), S.REASON_ROUTE)
        .when(F.col(_MARK_VEHICLE).isNull(), S.REASON_VEHICLE)
    )
    return marked.select(*columns, reason.alias(S.REASON_COLUMN))


def split_clean_bad(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows as silver rows, and the rows that carry a reason."""
    reason = F.col(S.REASON_COLUMN)
    silver = [c for c in classified.columns if c not in _DROPPED_FROM_SILVER]
    return classified.where(reason.isNull()).select(*silver), classified.where(reason.isNotNull())


def quarantine_rows(classified: DataFrame, at: dt.datetime | str | None = None) -> DataFrame:
    """The rejected rows with reason, source file and time of rejection."""
    _, bad = split_clean_bad(classified)
    if S.LINEAGE_COLUMN in bad.columns:
        bad = bad.withColumn("source_file", F.col(S.LINEAGE_COLUMN)).drop(S.LINEAGE_COLUMN)
    elif "source_file" not in bad.columns:
        bad = bad.withColumn("source_file", F.lit(None).cast("string"))
    stamp = F.current_timestamp() if at is None else F.lit(_utc_text(at)).cast("timestamp")
    return bad.withColumn("quarantined_at", stamp)


def reason_counts(classified: DataFrame) -> DataFrame:
    """Rejected rows per reason."""
    _, bad = split_clean_bad(classified)
    return bad.groupBy(S.REASON_COLUMN).agg(F.count(F.lit(1)).alias("bad_rows"))


def time_bounds(as_of: dt.datetime | str, max_age_days: int, future_days: int) -> tuple[str, str]:
    """First and last accepted start time: midnights, both included."""
    today = dt.date.fromisoformat(_utc_text(as_of)[:10])
    earliest = today - dt.timedelta(days=max_age_days)
    latest = today + dt.timedelta(days=future_days)
    return f"{earliest.isoformat()} 00:00:00", f"{latest.isoformat()} 00:00:00"


def _standard_columns(raw: DataFrame, run_id: str, as_of: dt.datetime | str) -> dict[str, Column]:
    types = {field.name: field.dataType for field in raw.schema.fields}
    start = parse_timestamp(F.col("start_time"), types["start_time"])
    end = parse_timestamp(F.col("end_time"), types["end_time"])
    clock = "timestamp_ntz" if isinstance(types["start_time"], T.TimestampNTZType) else "timestamp"
    return {
        "trip_id": F.trim("trip_id"),
        "route_id": pad_id(F.col("route_id"), "R", 3),
        "vehicle_id": pad_id(F.col("vehicle_id"), "V", 4),
        "status": F.lower(F.trim("status")),
        "start_time": start,
        "end_time": end,
        "distance_km": F.col("distance_km").try_cast("double"),
        "ingested_at": F.lit(_utc_text(as_of)).cast(clock),
        S.RUN_COLUMN: F.lit(run_id),
    }


def _in_silver_order(standard: dict[str, Column]) -> list[Column]:
    return [standard[name].alias(name) for name in S.SILVER_COLUMNS]


def _extra_columns(raw: DataFrame) -> list[str]:
    replaced = set(S.SILVER_COLUMNS) | _DROPPED_FROM_SILVER
    return [c for c in raw.columns if c not in replaced]


def _with_corrupt_column(raw: DataFrame) -> DataFrame:
    if S.CORRUPT_COLUMN in raw.columns:
        return raw
    return raw.withColumn(S.CORRUPT_COLUMN, F.lit(None).cast("string"))


def _marker(dimension: DataFrame, key: str, name: str) -> DataFrame:
    return dimension.select(key, F.lit(True).alias(name))


def _utc_text(moment: dt.datetime | str) -> str:
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc)
    return moment.strftime("%Y-%m-%d %H:%M:%S")
