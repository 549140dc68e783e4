"""Durations and calendar arithmetic. The run date is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayflow.functions.nulls import flag


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, truncated towards zero.

    Subtracting two zone-less timestamps gives an interval, so the result does
    not depend on the session zone; ``datediff`` would count midnights.
    """
    return F.extract(F.lit("DAY"), end - start).cast("bigint")


def calendar_days(start: Column, end: Column) -> Column:
    """Signed number of calendar days from one date to another."""
    return F.datediff(end, start).cast("bigint")


def month_start(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "MM")


def is_expired(expiry: Column, as_of: Column) -> Column:
    """True when the expiry day has passed; no expiry day means not expired."""
    return flag(expiry < as_of)


def is_depleted(quantity: Column) -> Column:
    """True when nothing is left; an unknown quantity means not depleted."""
    return flag(quantity <= 0)
