"""Large jobs in parts, so that the shuffle files of one part are gone before those of the next are written."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PASS_BYTES = 32 * 1024 * 1024  # bytes of files that are worth a pass of their own
MAX_PASSES = 4  # each pass reads the whole input
UNKNOWN_BYTES = 2**63 - 1  # what the planner says of rows that are in no file

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files; otherwise these stay until the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def passes(size: int) -> int:
    """In how many passes to work on so many bytes."""
    return max(1, min(MAX_PASSES, -(-size // PASS_BYTES)))


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame reads, partitions it prunes aside."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


def in_passes(df: DataFrame, key: str) -> list[DataFrame]:
    """All rows in frames that share no value of ``key``; rows with a NULL key are in one of them."""
    n = passes(file_bytes(df))
    return [df.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)] if n > 1 else [df]
