"""Record hashes, composite keys and the lookup of records already stored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_DIGITS = 12


def _sorted_fields(kind: T.StructType) -> list[T.StructField]:
    return sorted(kind.fields, key=lambda f: f.name)


def _canonical(value: Column, kind: T.DataType) -> Column:
    """The same value with the fields of every object in name order."""
    if isinstance(kind, T.StructType):
        ordered = F.struct(
            *(_canonical(value.getField(f.name), f.dataType).alias(f.name) for f in _sorted_fields(kind))
        )
        return F.when(value.isNotNull(), ordered)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return F.transform(value, lambda x: _canonical(x, kind.elementType))
    return value


def record_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Compact JSON of the record with sorted keys and explicit nulls."""
    fields = [f for f in _sorted_fields(df.schema) if columns is None or f.name in columns]
    ordered = F.struct(*(_canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields))
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def record_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 of :func:`record_json`, which decides whether two records are the same."""
    return F.sha2(record_json(df, columns), 256)


def record_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """First twelve hex digits of the digest: a short name of a record, not proof of equality."""
    return F.substring(record_digest(df, columns), 1, HASH_DIGITS)


def composite_key(*parts: Column) -> Column:
    """Key parts joined with a bar."""
    return F.concat_ws("|", *parts)


def new_records(
    incoming: DataFrame, stored: DataFrame, keys: Sequence[str] = ("id", "record_hash"), broadcast_keys: bool = False
) -> DataFrame:
    """Incoming records, each once, whose key is not stored yet.

    ``stored`` is read for its keys only, and first reduced to those the batch has: with
    ``broadcast_keys``, for which the caller has measured the batch's keys, that is a scan
    without a shuffle of the history.
    """
    batch = incoming.dropDuplicates(list(keys))
    wanted = incoming.select(*keys).distinct()
    known = stored.select(*keys).join(F.broadcast(wanted) if broadcast_keys else wanted, list(keys), "left_semi")
    return batch.join(known, list(keys), "left_anti")


def batch_keys(files: DataFrame, dataset: str, path: str, batch: Sequence[str]) -> DataFrame:
    """SHA-256 per batch over the dataset name and the sorted file paths.

    A batch is what one trigger picked up: its size is bounded by the
    source's file limit per trigger, so the list of its paths fits one row.
    """
    paths = F.sort_array(F.collect_list(F.col(path).cast("string")))
    return files.groupBy(dataset, *batch).agg(
        F.count(path).alias("n_files"),
        F.sha2(F.concat_ws("|", F.col(dataset), F.array_join(paths, "|")), 256).alias("batch_key"),
    )


def batch_key(dataset: str, paths: Iterable[str]) -> str:
    """The same key for a list of paths the caller already holds."""
    return hashlib.sha256("|".join([dataset, *sorted(paths)]).encode("utf-8")).hexdigest()
