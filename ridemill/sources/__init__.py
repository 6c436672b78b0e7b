from ridemill.sources.csv_shapes import discover_by_name, header_census, read_trips_by_name
from ridemill.sources.csv_trips import (
    discover_csv_schema,
    distinct_paths,
    parse_trip_lines,
    read_trips_csv,
    stream_trips_csv,
)
from ridemill.sources.dimensions import read_dimension

__all__ = [
    "discover_by_name",
    "discover_csv_schema",
    "distinct_paths",
    "header_census",
    "parse_trip_lines",
    "read_dimension",
    "read_trips_by_name",
    "read_trips_csv",
    "stream_trips_csv",
]
