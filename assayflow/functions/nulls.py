"""Expressions with an explicit rule for NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def greatest_strict(*cols: Column) -> Column:
    """Largest value, or NULL as soon as one input is NULL (``F.greatest`` skips NULLs)."""
    any_null = reduce(lambda a, b: a | b, (c.isNull() for c in cols))
    return F.when(~any_null, F.greatest(*cols))


def flag(condition: Column) -> Column:
    """Boolean that is never NULL: an unknown condition counts as false."""
    return F.when(condition, F.lit(True)).otherwise(F.lit(False))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio as double, NULL where the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))
