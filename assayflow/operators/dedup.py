"""Newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_orderable(kind: T.DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(kind, T.ArrayType):
        return is_orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(is_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the first row of each key under a total order.

    ``tie_break`` defaults to every other column, so that two rows tie only when
    they are equal and a rerun picks the same row. Sort columns are compared left to
    right and only as far as needed, which costs less than hashing each record.

    Spark plans ``row_number() = 1`` with a group limit *before* the shuffle: a
    map task sends at most one row per key, however hot the key is.
    """
    if tie_break is None:
        tie_break = [f.name for f in df.schema.fields if f.name not in keys and is_orderable(f.dataType)]
    order = [*order_by, *(F.col(f"`{c}`").asc_nulls_last() for c in tie_break)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("row_num", F.row_number().over(window)).filter("row_num = 1").drop("row_num")
