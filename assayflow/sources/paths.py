"""Where a job may put intermediate files, and what is there already."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder the session names.

    The cluster sets ``spark.checkpoint.dir``. Without it a local session uses a
    temporary folder; on a cluster that would be unreachable for executors, so
    there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="assayflow-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system a path lives on, and the path itself, for small metadata calls."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.exists(jvm_path)
