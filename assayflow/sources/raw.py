"""Raw Parquet tables, partitioned by ingest day."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.operators.flatten import flatten, flatten_variant
from assayflow.operators.keys import HASH_DIGITS, batch_key, new_records
from assayflow.operators.observe import noted
from assayflow.operators.schema import conform, merge_schemas, schema_changes
from assayflow.sources.landing import METADATA_COLUMNS, RECORD, found_schema, grown, misfits, read_records, split_corrupt
from assayflow.sources.passes import shuffles_deleted
from assayflow.sources.paths import hadoop_path, path_exists, scratch_dir
from assayflow.sources.registry import Dataset
from assayflow.sources.tables import BROADCAST_LIMIT, CODEC, ROW_OVERHEAD

log = logging.getLogger(__name__)
PARTITIONS = T.StructType([T.StructField("ingest_date", T.DateType()), T.StructField("source_batch", T.StringType())])


RECORD_HASH, RECORD_DIGEST = "record_hash", "record_digest"
#: Folder of a compacted day, the column with the batch of its rows, and the folder that lists these batches.
CLOSED, BATCH_KEY, CLOSED_BATCHES = "closed", "batch_key", "_closed"
CLOSED_DDL = f"{BATCH_KEY} string, day string"


def to_raw(records: DataFrame, schema: T.StructType, on_collision: str = "last_wins", arrays: str = "last_element") -> DataFrame:
    """Flat records with the file they came from, the digest of the landed record and its short form.

    The digest is of the whole record, its fields in order of name: an explicit null and an absent field differ.
    """
    tagged = records.withColumn(RECORD_DIGEST, F.sha2(F.to_json(RECORD), 256))
    tagged = tagged.withColumn(RECORD_HASH, F.substring(RECORD_DIGEST, 1, HASH_DIGITS))
    return flatten_variant(tagged.select(RECORD, *METADATA_COLUMNS, RECORD_HASH, RECORD_DIGEST), RECORD, schema, on_collision, arrays)


def raw_schema(spark: SparkSession, ds: Dataset, arrays: str) -> T.StructType:
    """Columns of the raw table: the flattened landing schema, file metadata, partitions."""
    empty = spark.createDataFrame([], ds.landing_schema)
    schema = flatten(empty, arrays=arrays).schema
    for name in (*METADATA_COLUMNS, RECORD_HASH, RECORD_DIGEST):
        schema = schema.add(name, T.StringType())
    return T.StructType(schema.fields + PARTITIONS.fields)


def write_raw(df: DataFrame, path: str, batch: str, spread_by: str | None = None) -> None:
    """Add one batch. Writing the same batch again replaces it instead of doubling it.

    Only the (day, batch) partitions present in ``df`` are overwritten. An ordinary
    batch has one day and is written where it was read. For a load of many
    days name a column in ``spread_by``: rows are then ranged by day and that
    column, so that a task writes few days and a big day is shared by several tasks.
    """
    tagged = df.withColumn("source_batch", F.lit(batch))
    if spread_by:
        tagged = tagged.repartitionByRange("ingest_date", spread_by)
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
    with shuffles_deleted(df.sparkSession):
        writer.partitionBy(*PARTITIONS.fieldNames()).parquet(path)


def _with_own_batch(rows: DataFrame) -> DataFrame:
    """The rows of compacted days under the batch they came with."""
    return rows.withColumn("source_batch", F.coalesce(BATCH_KEY, "source_batch")).drop(BATCH_KEY)


def scan_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The raw table under its declared schema; files lacking a column give NULL.

    A filter on ``ingest_date`` prunes partitions.
    """
    return _with_own_batch(spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH_KEY, T.StringType())])).parquet(path))


def stored_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The declared schema and what undeclared columns stored files have besides; opens every file's footer."""
    found = merge_schemas(schema, spark.read.option("mergeSchema", True).parquet(path).schema)
    return T.StructType([f for f in found.fields if f.name != BATCH_KEY])


def stored_day(spark: SparkSession, path: str, batch: str) -> date | None:
    """The ingest day under which a batch is stored already, in a folder of its own or in a compacted day."""
    fs, pattern = hadoop_path(spark, f"{path}/ingest_date=*/source_batch={batch}")
    days = [str(s.getPath().getParent().getName()).split("=")[1] for s in fs.globStatus(pattern) or []]
    if not days and path_exists(spark, f"{path}/{CLOSED_BATCHES}"):
        closed = spark.read.schema(CLOSED_DDL).parquet(f"{path}/{CLOSED_BATCHES}")
        days = [r.day for r in closed.filter(F.col(BATCH_KEY) == batch).select("day").collect()]
    return date.fromisoformat(min(days)) if days else None


def _close(spark: SparkSession, path: str, day: date, rows: DataFrame, gone: list[str]) -> None:
    """Put the rows in place of folders of a day, and note which batches they have.

    The rows are complete in a hidden folder before anything is deleted. Between the deletion and the renaming, two
    calls, the day has no rows for a reader; one writer at a time is assumed.
    """
    draft, final = f"{path}/_compacting-{day}", f"{path}/ingest_date={day}/source_batch={CLOSED}"
    rows.hint("rebalance").write.mode("overwrite").parquet(draft)
    batches = spark.read.schema(rows.schema).parquet(draft).select(BATCH_KEY, F.lit(str(day)).alias("day")).distinct()
    batches.write.mode("overwrite").parquet(f"{path}/{CLOSED_BATCHES}/closed_on={day}")
    fs, source = hadoop_path(spark, draft)
    for name in gone:
        fs.delete(hadoop_path(spark, f"{path}/ingest_date={day}/{name}")[1], True)
    if not fs.rename(source, hadoop_path(spark, final)[1]):
        raise RuntimeError(f"the compacted rows of {day} are in {draft}")


def _day_rows(spark: SparkSession, path: str, day: date) -> DataFrame:
    """All rows of a day with all columns its files have, each with its batch."""
    folder = f"{path}/ingest_date={day}"
    found = spark.read.option("mergeSchema", True).parquet(folder).schema
    fields = [f for f in found.fields if f.name not in ("source_batch", BATCH_KEY)]
    whole = T.StructType(fields).add("source_batch", T.StringType()).add(BATCH_KEY, T.StringType())
    rows = spark.read.schema(whole).option("basePath", folder).parquet(folder)
    return _with_own_batch(rows).withColumnRenamed("source_batch", BATCH_KEY)


def compact_days(spark: SparkSession, path: str, before: date) -> list[date]:
    """Rewrite every day before the given one that has folders of single batches as one folder of few files.

    A batch stays its own: its key is a column, and a batch that runs again replaces its rows, as before.
    Returns the days that were rewritten. Streams of the raw table do not read rows a second time.
    """
    fs, pattern = hadoop_path(spark, f"{path}/ingest_date=*/source_batch=*")
    folders: dict[str, list[str]] = {}
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        folders.setdefault(str(folder.getParent().getName()).split("=")[1], []).append(str(folder.getName()))
    days = sorted(d for d, names in folders.items() if d < str(before) and names != [f"source_batch={CLOSED}"])
    for day in days:
        _close(spark, path, day, _day_rows(spark, path, day), folders[day])
    return [date.fromisoformat(d) for d in days]


def _reopen(spark: SparkSession, path: str, day: date, batch: str) -> None:
    """Take a batch that will be written again out of a compacted day."""
    closed = f"ingest_date={day}/source_batch={CLOSED}"
    if not path_exists(spark, f"{path}/{closed}") or path_exists(spark, f"{path}/ingest_date={day}/source_batch={batch}"):
        return
    rows = spark.read.option("mergeSchema", True).parquet(f"{path}/{closed}").filter(F.col(BATCH_KEY) != batch)
    _close(spark, path, day, rows, [f"source_batch={CLOSED}"])


def add_batch(
    spark: SparkSession, ds: Dataset, rows: DataFrame, root: str, batch: str, arrays: str, skip_stored: bool = False
) -> None:
    """Write one batch of raw rows under the declared schema, undeclared columns behind it.

    With ``skip_stored`` records whose key and digest came with another batch, or
    occur twice in this one, are left out; the stored rows are read for these two columns only.
    """
    schema, path = raw_schema(spark, ds, arrays), ds.raw_path(root)
    changes = schema_changes(rows, T.StructType(schema.fields[:-1]))
    if changes["added"]:
        log.warning("%s: undeclared columns %s", ds.name, changes["added"])
    rows = conform(rows, merge_schemas(T.StructType(schema.fields[:-1]), rows.schema))
    keys = (ds.key, RECORD_DIGEST)
    if skip_stored and path_exists(spark, path):
        stored = scan_raw(spark, path, schema).filter(F.col("source_batch") != batch)
        size = F.sum(F.octet_length(F.concat_ws("", *(F.col(k).cast("string") for k in keys))) + ROW_OVERHEAD)
        small = (rows.agg(size).head()[0] or 0) <= BROADCAST_LIMIT
        rows = new_records(rows, stored, keys, broadcast_keys=small).select(*rows.columns)
    elif skip_stored:
        rows = rows.dropDuplicates(list(keys))
    for day in {r[0] for r in rows.select("ingest_date").distinct().collect()} if path_exists(spark, f"{path}/{CLOSED_BATCHES}") else ():
        _reopen(spark, path, day, batch)
    write_raw(rows, path, batch)


def ingest_files(
    spark: SparkSession,
    ds: Dataset,
    paths: list[str],
    root: str,
    ingest_date: date,
    arrays: str,
    skip_stored: bool = False,
    quarantine: bool = False,
    names: Sequence[str] | None = None,
    any_large: bool = True,
) -> str:
    """Read the listed files in one job and add them to the raw table; returns the batch key.

    The key is made of the files' ``names``, by default their paths. Files that were ingested together before, on whatever day, replace
    what they gave then. A file that is no JSON, or a record that has no object or list where one is
    declared, fails the batch, or with ``quarantine`` goes to ``quarantine/<dataset>`` under the root, never into
    the raw table. The files are read once; fields beyond the declared ones are found in that pass.
    """
    key = batch_key(ds.name, paths if names is None else names)
    day = stored_day(spark, ds.raw_path(root), key) or ingest_date
    landed, found, folder = parse_once(read_records(spark, paths, quarantine=quarantine, any_large=any_large))
    misshapen = misfits(ds.landing_schema, found)
    if quarantine:
        landed, bad = split_corrupt(landed, misshapen)
        write_raw(bad.withColumn("ingest_date", F.lit(day)), f"{root}/quarantine/{ds.name}", key)
    elif misshapen:
        told = "; ".join(f"{'.'.join(path) or 'record'} is {was.simpleString()}" for path, _, was in misshapen)
        raise ValueError(f"malformed records of {ds.name}: {told}")
    flat = to_raw(landed, grown(ds.landing_schema, found), arrays=arrays)
    add_batch(spark, ds, flat.withColumn("ingest_date", F.lit(day)), root, key, arrays, skip_stored)
    fs, staged = hadoop_path(spark, folder)
    fs.delete(staged, True)
    return key


def parse_once(records: DataFrame) -> tuple[DataFrame, T.DataType | None, str]:
    """The records stored as VARIANTs, what fields they have, and the folder: both from one pass over the files."""
    spark, folder = records.sparkSession, scratch_dir(records.sparkSession, "landed-records")
    seen = Observation()
    records.observe(seen, F.schema_of_variant_agg(RECORD).alias("found")).write.parquet(folder)
    return spark.read.schema(records.schema).parquet(folder), found_schema(noted(seen).get("found")), folder


def stream_raw(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1000) -> DataFrame:
    """New rows of the raw table as a stream; those of compacted days have been there before."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    return rows.filter(F.col("source_batch") != CLOSED)
