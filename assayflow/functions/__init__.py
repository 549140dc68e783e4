"""Column expressions whose meaning differs between SQL engines."""

from assayflow.functions.casts import as_date, as_integer, as_timestamp
from assayflow.functions.nulls import flag, greatest_strict, safe_ratio
from assayflow.functions.temporal import (
    calendar_days,
    elapsed_days,
    is_depleted,
    is_expired,
    month_start,
)
from assayflow.functions.text import blank_to_null, trim_whitespace

__all__ = [
    "as_date",
    "as_integer",
    "as_timestamp",
    "blank_to_null",
    "calendar_days",
    "elapsed_days",
    "flag",
    "greatest_strict",
    "is_depleted",
    "is_expired",
    "month_start",
    "safe_ratio",
    "trim_whitespace",
]
