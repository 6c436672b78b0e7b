from ridemill.functions.calendar import (
    as_day,
    between_days,
    date_spine,
    day_literal,
    rolling_window_expand,
    shift_day,
)
from ridemill.functions.columns import (
    blank,
    duration_minutes,
    duration_us,
    mean_minutes,
    pad_id,
    parse_timestamp,
    split_seconds,
    status_count,
    whole_minutes,
    zscore,
)

__all__ = [
    "as_day",
    "between_days",
    "blank",
    "date_spine",
    "day_literal",
    "duration_minutes",
    "duration_us",
    "mean_minutes",
    "pad_id",
    "parse_timestamp",
    "rolling_window_expand",
    "shift_day",
    "split_seconds",
    "status_count",
    "whole_minutes",
    "zscore",
]
