"""Record layouts and the fixed text values of the trip tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
REASON_COLUMN = "quarantine_reason"
RUN_COLUMN = "sfn_execution_id"
DAY_COLUMN = "start_date"
# Path of the landing file, captured at scan; becomes `source_file` in quarantine.
LINEAGE_COLUMN = "_source_file"

RAW_TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.StringType()),
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("end_time", T.StringType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("vehicle_id_raw", T.StringType()),
    ]
)

SILVER_COLUMNS = (
    "trip_id",
    "route_id",
    "vehicle_id",
    "status",
    "start_time",
    "end_time",
    "distance_km",
    "ingested_at",
    RUN_COLUMN,
)

ENRICHED_COLUMNS = (
    "trip_id",
    "vehicle_id",
    "route_id",
    "start_time",
    "end_time",
    "distance_km",
    "status",
    RUN_COLUMN,
    "vehicle_type",
    "capacity",
)

DIM_ROUTES = T.StructType(
    [
        T.StructField("route_id", T.StringType()),
        T.StructField("route_name", T.StringType()),
        T.StructField("start_location", T.StringType()),
        T.StructField("end_location", T.StringType()),
    ]
)

DIM_VEHICLES = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("vehicle_type", T.StringType()),
        T.StructField("capacity", T.IntegerType()),
        T.StructField("manufacturer", T.StringType()),
    ]
)

RUN_METADATA = T.StructType(
    [
        T.StructField(RUN_COLUMN, T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
    ]
)

# Texts stored in the quarantine and outlier tables.
REASON_CORRUPT = "Malformed CSV parsing failure"
REASON_MISSING_KEY = "Missing primary identifier (trip_id, route_id, or vehicle_id)"
REASON_TEMPORAL = "Temporal validation failure: start_time is in the future or older than 30 days"
REASON_ROUTE = "Referential validation failure: route_id not found in dim_routes"
REASON_VEHICLE = "Referential validation failure: vehicle_id not found in dim_vehicles"
REASONS = (REASON_CORRUPT, REASON_MISSING_KEY, REASON_TEMPORAL, REASON_ROUTE, REASON_VEHICLE)
OUTLIER_DURATION = "Statistical duration outlier (Z-Score > 3.0)"
OUTLIER_DISTANCE = "Abnormal distance outlier (> 80 km)"
OUTLIER_NONE = "Normal"
STATUS_COMPLETED = "completed"
STATUS_IN_PROGRESS = "in_progress"


@dataclass(frozen=True)
class GoldTable:
    """A business table: columns with SQL types, key, and the column that dates its rows."""

    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]
    dated_by: str

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def stage_name(self) -> str:
        return f"stage_{self.name}"


# Names, types and keys of the published tables.
GOLD_DAILY = GoldTable(
    "gold_daily_ridership",
    (
        ("trip_date", "DATE"),
        ("route_id", "VARCHAR(50)"),
        ("vehicle_type", "VARCHAR(50)"),
        ("total_trips", "INT"),
        ("unique_vehicles", "INT"),
        ("avg_capacity", "DOUBLE PRECISION"),
        ("avg_duration_minutes", "DOUBLE PRECISION"),
        ("max_duration_minutes", "DOUBLE PRECISION"),
        ("trips_completed", "INT"),
        ("trips_in_progress", "INT"),
        ("peak_hour", "INT"),
    ),
    ("trip_date", "route_id", "vehicle_type"),
    "trip_date",
)
GOLD_WEEKLY = GoldTable(
    "gold_top_routes_weekly",
    (
        ("calculation_date", "DATE"),
        ("route_rank", "INT"),
        ("route_id", "VARCHAR(50)"),
        ("total_trips", "INT"),
        ("total_completed_trips", "INT"),
        ("avg_trip_duration_minutes", "DOUBLE PRECISION"),
    ),
    ("calculation_date", "route_id"),
    "calculation_date",
)
GOLD_OUTLIERS = GoldTable(
    "gold_trip_outliers",
    (
        ("trip_id", "VARCHAR(100)"),
        ("route_id", "VARCHAR(50)"),
        ("vehicle_id", "VARCHAR(50)"),
        ("start_time", "TIMESTAMP"),
        ("end_time", "TIMESTAMP"),
        ("duration_minutes", "DOUBLE PRECISION"),
        ("avg_duration_minutes", "DOUBLE PRECISION"),
        ("stddev_duration_minutes", "DOUBLE PRECISION"),
        ("z_score", "DOUBLE PRECISION"),
        ("outlier_reason", "VARCHAR(255)"),
    ),
    ("trip_id",),
    "start_time",
)
GOLD_TABLES = (GOLD_DAILY, GOLD_WEEKLY, GOLD_OUTLIERS)
