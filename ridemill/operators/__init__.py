from ridemill.operators.dedupe import dedupe_batch, latest_per_trip
from ridemill.operators.lookup import (
    enrich_trips,
    fits_broadcast,
    known_keys,
    sized,
    unique_lookup,
    unknown_keys,
    with_dimension,
)
from ridemill.operators.merge import merge_trips, replace_date_range
from ridemill.operators.metrics import observe_batch, observe_reasons
from ridemill.operators.outliers import fold_duration_stats, route_duration_stats, score_trips, trip_outliers, trip_outliers_on
from ridemill.operators.rankings import fold_weekly, top_routes_last_week, weekly_rolling_counts, weekly_top_routes
from ridemill.operators.reports import latest_daily, latest_top_routes, worst_outliers
from ridemill.operators.ridership import daily_ridership, day_sums, fold_daily, hourly_counts, load_window, peak_hours
from ridemill.operators.validate import (
    classify_trips,
    normalize_trips,
    quarantine_rows,
    reason_counts,
    split_clean_bad,
)

__all__ = [
    "classify_trips",
    "daily_ridership",
    "day_sums",
    "dedupe_batch",
    "enrich_trips",
    "fits_broadcast",
    "fold_daily",
    "fold_duration_stats",
    "fold_weekly",
    "hourly_counts",
    "known_keys",
    "latest_daily",
    "latest_per_trip",
    "latest_top_routes",
    "load_window",
    "merge_trips",
    "normalize_trips",
    "observe_batch",
    "observe_reasons",
    "peak_hours",
    "quarantine_rows",
    "reason_counts",
    "replace_date_range",
    "route_duration_stats",
    "score_trips",
    "sized",
    "split_clean_bad",
    "top_routes_last_week",
    "trip_outliers",
    "trip_outliers_on",
    "unique_lookup",
    "unknown_keys",
    "weekly_rolling_counts",
    "weekly_top_routes",
    "with_dimension",
    "worst_outliers",
]
