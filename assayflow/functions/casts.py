"""Casts from raw text and numbers to the declared types.

Bad text fails the query (ANSI mode), unless ``lenient`` asks for NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayflow.functions.text import blank_to_null


def _cast(col: Column, type_name: str, lenient: bool) -> Column:
    return col.try_cast(type_name) if lenient else col.cast(type_name)


def as_timestamp(col: Column, lenient: bool = False) -> Column:
    """Text to a timestamp without zone; the empty string is NULL."""
    return _cast(blank_to_null(col), "timestamp_ntz", lenient)


def as_date(col: Column, lenient: bool = False) -> Column:
    """Text to a date; the empty string is NULL."""
    return _cast(blank_to_null(col), "date", lenient)


def as_integer(col: Column, lenient: bool = False) -> Column:
    """Number to int, rounding halves away from zero; a bare Spark cast truncates."""
    return _cast(F.round(col.cast("double")), "int", lenient)
