"""Declarative projections: rename, clean and cast in one select."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.functions import as_date, as_integer, as_timestamp, trim_whitespace

CONVERSIONS: dict[str, Callable[[Column], Column]] = {
    "as_is": lambda c: c,
    "string": lambda c: c.cast("string"),
    "trim": trim_whitespace,
    "int": as_integer,
    "bigint": lambda c: c.cast("bigint"),
    "double": lambda c: c.cast("double"),
    "boolean": lambda c: c.cast("boolean"),
    "date": as_date,
    "day": lambda c: c.cast("date"),
    "timestamp": as_timestamp,
}


def project(df: DataFrame, specs: Sequence[str]) -> DataFrame:
    """Select columns by specs of the form ``source [conversion [target]]``.

    ``date`` and ``timestamp`` read text; ``day`` is for a column that is a date already.
    """
    out = []
    for spec in specs:
        source, *rest = spec.split()
        conversion = rest[0] if rest else "as_is"
        target = rest[1] if len(rest) > 1 else source
        out.append(CONVERSIONS[conversion](F.col(f"`{source}`")).alias(target))
    return df.select(*out)
