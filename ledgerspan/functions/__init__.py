"""Column helpers built from Spark's own expressions."""

from .calendar import (
    as_date,
    daily_series,
    days_between,
    days_in_month,
    days_left_in_month,
    month_bucket,
    month_series,
    month_text,
)
from .parsing import parse_amount, parse_us_timestamp
from .rounding import exact_sum, round_half_away

__all__ = [
    "as_date",
    "daily_series",
    "days_between",
    "days_in_month",
    "days_left_in_month",
    "exact_sum",
    "month_bucket",
    "month_series",
    "month_text",
    "parse_amount",
    "parse_us_timestamp",
    "round_half_away",
]
