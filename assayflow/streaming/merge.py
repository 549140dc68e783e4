"""Raw rows to a merged table, per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayflow.operators.dedup import dedup, is_orderable
from assayflow.operators.schema import conform
from assayflow.sources.paths import hadoop_path, scratch_dir
from assayflow.sources.tables import Table
from assayflow.streaming.ingest import start


def merge_batch(table: Table, batch: DataFrame, order_by: Sequence[Column], late_safe: bool) -> None:
    """Newest version per key of the batch, merged into the table.

    With ``late_safe`` the stored version competes by the same order, so a late record of
    an older version changes nothing; the batch is reduced and written once, and only the
    buckets its keys are in are read. Merging the same batch twice changes nothing, except that rows
    with a NULL key match nothing and are added each time.
    """
    newest = dedup(batch, table.keys, order_by)
    if not (late_safe and table.exists()):
        table.merge(newest)
        return
    spark, path = batch.sparkSession, scratch_dir(batch.sparkSession, "merge-batch")
    newest.write.parquet(path)
    staged = spark.read.schema(newest.schema).parquet(path)
    stored = table.read_matching(staged)
    table.merge(dedup(stored.unionByName(conform(staged, stored.schema)), table.keys, order_by))
    fs, folder = hadoop_path(spark, path)
    fs.delete(folder, True)


def merge_stream(
    source: DataFrame,
    table: Table,
    order_by: Sequence[Column],
    checkpoint: str,
    model: Callable[[DataFrame], DataFrame] = lambda df: df,
    late_safe: bool = True,
    once: bool = True,
) -> StreamingQuery:
    """Keep the table at the newest version per key of everything the stream delivered."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        merge_batch(table, model(batch), order_by, late_safe)

    return start(source, on_batch, checkpoint, once)


def newest_stream(source: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The rows that became the newest version of their key, as a stream to be written in update mode.

    Spark's state store holds one version per key, that with the largest ``newest_by`` (compared left to
    right, NULL smallest). A late or repeated version passes no further, so it rewrites nothing
    downstream. Of versions that tie, the one of the earlier batch stays, and within a batch their other columns
    decide. Rows with NULL in a key are versions of that NULL key.

    A version carries the clock of its batch, which the checkpoint keeps: a batch that runs again has the
    same, and a version is new exactly while that is the present one. Two batches of equal clocks
    would let an unchanged version pass once more, which merging it forgives.
    """
    columns = source.schema.fields
    others = [F.col(f"`{f.name}`") for f in columns if f.name not in newest_by and is_orderable(f.dataType)]
    clock = F.current_timestamp()
    version = F.struct(F.struct(*[F.col(f"`{f.name}`") for f in columns]).alias("row"), clock.alias("arrived"))
    rank = F.struct(*[F.col(f"`{c}`") for c in newest_by], -F.unix_micros(clock), F.xxhash64(*others))
    own = [F.col(f"`{k}`").alias(f"key_{i}") for i, k in enumerate(keys)]
    versions = source.select(*own, version.alias("version"), rank.alias("rank")).groupBy(*[f"key_{i}" for i in range(len(keys))])
    newest = versions.agg(F.max_by("version", "rank").alias("newest"))
    return newest.where(F.col("newest.arrived") == clock).select("newest.row.*")


def merge_newest_stream(
    source: DataFrame, table: Table, newest_by: Sequence[str], checkpoint: str, once: bool = True
) -> StreamingQuery:
    """`merge_stream` with the newest versions kept in the state store: late versions rewrite no bucket.

    The stored version competes as well, so a fresh checkpoint over a filled table loses nothing.
    """
    order = [F.col(f"`{c}`").desc_nulls_last() for c in newest_by]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        merge_batch(table, batch, order, late_safe=True)

    return start(newest_stream(source, table.keys, newest_by), on_batch, checkpoint, once, "update")
