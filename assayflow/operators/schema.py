"""Bring files of differing columns to one declared schema."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.functions import as_integer


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order: missing ones NULL, others cast, extra ones left out."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField):
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegerType) and isinstance(have[field.name], T.FractionalType):
            return as_integer(value).alias(field.name)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*(column(f) for f in schema.fields))


def schema_changes(df: DataFrame, schema: T.StructType) -> dict[str, list[str]]:
    """Column names added, deleted and retyped against the declared schema, for the log."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    return {
        "added": sorted(have.keys() - want.keys()),
        "deleted": sorted(want.keys() - have.keys()),
        "retyped": sorted(n for n in have.keys() & want.keys() if have[n] != want[n]),
    }


def merge_schemas(base: T.StructType, *others: T.StructType) -> T.StructType:
    """Add the columns that are new in ``others`` behind those of ``base``; never drop or retype."""
    merged = T.StructType(list(base.fields))
    for other in others:
        for field in other.fields:
            if field.name not in merged.fieldNames():
                merged = merged.add(field.name, field.dataType, True)
    return merged


def union_evolving(frames: Iterable[DataFrame], schema: T.StructType) -> DataFrame:
    """Union of differing frames under the declared schema grown by their new columns."""
    frames = list(frames)
    grown = merge_schemas(schema, *(f.schema for f in frames))
    return reduce(DataFrame.unionByName, (conform(f, grown) for f in frames))
