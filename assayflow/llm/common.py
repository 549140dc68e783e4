"""What the operators share: table access, staging in the shared folder, output digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.sources.paths import hadoop_path, scratch_dir

#: A word: a longest run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(frame: DataFrame, purpose: str, **options) -> tuple[DataFrame, str]:
    """The frame written once to the folder all executors share, and that folder; `options` are the writer's.

    Cuts the lineage, so that a lost executor costs a reread and no recomputation,
    and lets a result be used several times without being computed again.
    """
    spark = frame.sparkSession
    path = scratch_dir(spark, purpose)
    frame.write.options(**options).option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table that nothing reads any more."""
    fs, jvm_path = hadoop_path(spark, path)
    fs.delete(jvm_path, True)


def whole_text(column: str) -> F.Column:
    """A text; NULL counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))
