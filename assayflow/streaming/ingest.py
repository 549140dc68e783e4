"""Landing to raw, continuously."""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayflow.operators.keys import batch_keys
from assayflow.sources.landing import FILE_PATTERN, WHOLE_FILE_BYTES, stream_files
from assayflow.sources.raw import ingest_files
from assayflow.sources.registry import Dataset

POLL_SECONDS = 300


def start(df: DataFrame, on_batch, checkpoint: str, once: bool, mode: str = "append") -> StreamingQuery:
    """Run ``on_batch`` for what is there now (``once``) or poll for new files for ever."""
    trigger = {"availableNow": True} if once else {"processingTime": f"{POLL_SECONDS} seconds"}
    writer = df.writeStream.outputMode(mode).foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def ingest_stream(
    spark: SparkSession,
    ds: Dataset,
    root: str,
    arrays: str,
    ingest_date: date | None = None,
    once: bool = True,
    max_files_per_trigger: int = 1000,
    pattern: str = FILE_PATTERN,
    skip_stored: bool = False,
) -> StreamingQuery:
    """Add every new landed file to the raw table, exactly once.

    The stream carries the paths of new files; each batch of them, at most
    ``max_files_per_trigger``, is read as `ingest_files` does and named by its content. The
    checkpoint advances after a batch has been written. A batch that runs again, also from a
    fresh checkpoint or on a later day, replaces its own rows.
    """
    files = stream_files(spark, ds.landing_path(root), max_files_per_trigger, pattern)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("source_file_path", "length", F.current_date().alias("day")).collect()
        if rows:
            names = sorted(r.source_file_path for r in rows)
            paths = [unquote(name) for name in names]
            large, day = any(r.length > WHOLE_FILE_BYTES for r in rows), ingest_date or rows[0].day
            ingest_files(batch.sparkSession, ds, paths, root, day, arrays, skip_stored, names=names, any_large=large)

    return start(files, on_batch, f"{root}/checkpoints/raw-{ds.name}", once)


def batch_lineage(raw: DataFrame, dataset_name: str) -> DataFrame:
    """Per batch of the raw table: how many files it came from and their common key."""
    files = raw.select(F.lit(dataset_name).alias("dataset"), "source_batch", "source_file_path").distinct()
    return batch_keys(files, "dataset", "source_file_path", ["source_batch"])
