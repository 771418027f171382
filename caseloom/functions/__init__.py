"""Column-level helpers: each takes and returns Spark columns, and stays inside code generation."""

from .aggregates import int_avg, mean, money_text, percent, rounded_ratio, safe_ratio
from .dates import anchored_week, calendar_week, minute_boundaries, month_of, sunday_week, weekday_name
from .text import (
    blank_to_null,
    ci_equals,
    fraction_part,
    has_text,
    month_start_from_text,
    split_list,
    strip_units,
    trimmed_length,
    without_fraction,
)

__all__ = [
    "anchored_week", "blank_to_null", "calendar_week", "ci_equals", "fraction_part", "has_text", "int_avg", "mean",
    "minute_boundaries", "money_text", "month_of", "month_start_from_text", "percent", "rounded_ratio",
    "safe_ratio", "split_list", "strip_units", "sunday_week", "trimmed_length", "weekday_name", "without_fraction",
]
