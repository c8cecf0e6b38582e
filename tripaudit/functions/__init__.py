"""Column-level building blocks (built-in Spark expressions only)."""

from tripaudit.functions.stats import null_safe_corr
from tripaudit.functions.text import (
    contains_any,
    hrefs,
    last_segment,
)
from tripaudit.functions.time import days_to_next_year, in_month, month_bounds, month_start, shift_days
from tripaudit.functions.trips import (
    duration_hours,
    duration_seconds,
    ghost_flag,
    rule_fast,
    rule_short_expensive,
    rule_zero_distance,
    speed_mph,
)

__all__ = [
    "contains_any",
    "days_to_next_year",
    "duration_hours",
    "duration_seconds",
    "ghost_flag",
    "hrefs",
    "in_month",
    "last_segment",
    "month_bounds",
    "month_start",
    "null_safe_corr",
    "rule_fast",
    "rule_short_expensive",
    "rule_zero_distance",
    "shift_days",
    "speed_mph",
]
