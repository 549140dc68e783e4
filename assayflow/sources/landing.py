"""Landed JSON: readers for batch and stream, and the export that writes the same form.

A file is parsed once, into one VARIANT, from which fields are taken by path, so that an explicit null
and an absent field stay apart and fields that no schema declares are seen in the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.operators.variants import as_text, ddl, variant_path

#: What landed files are called: arrays of other systems, and those `write_landing` writes.
FILE_PATTERN = "{*.json,part-*.txt}"
CORRUPT = "_corrupt_record"
RECORD = "record"
LISTING = "path string, modificationTime timestamp, length bigint, content binary"
METADATA_COLUMNS = ("source_file_name", "source_file_path")
#: Path, declared type and found type of something that has another shape than declared.
Misfit = tuple[tuple[str, ...], T.DataType, T.DataType]
#: A VARIANT holds 128 MiB, and small numbers take more there than in their file; files beyond this size are read field by field.
WHOLE_FILE_BYTES = 32 << 20


def with_source_file(df: DataFrame) -> DataFrame:
    """Name and path of the file each record came from."""
    return df.withColumns(
        {"source_file_name": F.col("_metadata.file_name"), "source_file_path": F.col("_metadata.file_path")}
    )


def object_key(path: Column) -> Column:
    """Path without scheme and bucket: ``s3://bucket/a/b.json`` gives ``a/b.json``."""
    return F.regexp_replace(path, "^[A-Za-z0-9]+://[^/]*/", "")


def _options(pattern: str) -> dict:
    # Recursive lookup also keeps folder names such as run_date=... from becoming columns,
    # which would replace the field of that name inside the records.
    return {"multiLine": True, "pathGlobFilter": pattern, "recursiveFileLookup": True}


def _file_size(df: DataFrame, above: bool) -> DataFrame:
    """Only the files above or up to the size that is read whole; the others are not opened."""
    size = F.col("_metadata.file_size")
    return df.filter(size > WHOLE_FILE_BYTES if above else size <= WHOLE_FILE_BYTES)


def _large_files(spark: SparkSession, paths: list[str], pattern: str, quarantine: bool) -> DataFrame | None:
    """Records of the files that are too large to be one value, or None without such files."""
    files = spark.read.format("binaryFile").options(pathGlobFilter=pattern, recursiveFileLookup=True).load(paths)
    if not files.filter(F.col("length") > WHOLE_FILE_BYTES).select("path").head(1):
        return None
    mode = {"mode": "PERMISSIVE" if quarantine else "FAILFAST"}
    # The reader cuts an array into its elements if it knows their fields, which takes a read for their names.
    names = sorted(_file_size(spark.read.options(primitivesAsString=True, **mode, **_options(pattern)).json(paths), True).schema.names)
    fields = T.StructType([T.StructField(n, T.VariantType()) for n in names if n != CORRUPT])
    reader = spark.read.options(columnNameOfCorruptRecord=CORRUPT, **mode, **_options(pattern))
    read = _file_size(with_source_file(reader.schema(fields.add(CORRUPT, T.StringType()) if quarantine else fields).json(paths)), True)
    record = F.parse_json(F.to_json(F.struct(*(F.col(f"`{n}`") for n in fields.names if n != CORRUPT))))
    bad = F.col(CORRUPT).isNotNull() if quarantine else F.lit(False)
    kept = [CORRUPT] if quarantine else []
    return read.select(F.when(~bad, record).alias(RECORD), *kept, *METADATA_COLUMNS)


def read_records(
    spark: SparkSession, paths: str | Sequence[str], pattern: str = FILE_PATTERN, quarantine: bool = False, any_large: bool = True
) -> DataFrame:
    """Files holding one JSON array each: every element as a VARIANT in `record`, and the file it came from.

    All paths go into one read. A file is parsed once, by one task, as one value, so land many moderate
    files rather than one huge one; files above WHOLE_FILE_BYTES are parsed once more, for the names of
    their fields; say so if there are none, and they are not looked for. A file that is no JSON fails the read; with ``quarantine`` it
    becomes a row without record, its content in the column ``_corrupt_record``. Numbers are as any JSON
    parser has them: integers beyond 38 digits are doubles, a decimal has no trailing zeros.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format("json").options(**_options(pattern))
    if quarantine:
        schema = T.StructType().add("landed", T.VariantType()).add(CORRUPT, T.StringType())
        reader = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, singleVariantColumn="landed").schema(schema)
    else:
        reader = reader.options(mode="FAILFAST", singleVariantColumn="landed")
    kept = [CORRUPT] if quarantine else []
    whole = with_source_file(reader.load(paths))
    large = _large_files(spark, paths, pattern, quarantine) if any_large else None
    if large is not None:
        whole = _file_size(whole, False)
    # A file may also hold a single object.
    elements = F.coalesce(F.try_variant_get("landed", "$", "array<variant>"), F.array("landed"))
    records = whole.select(F.explode(elements).alias(RECORD), *kept, *METADATA_COLUMNS)
    return records if large is None else records.unionByName(large)


def typed_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """The records as columns of the schema, in place of `record`; text that is no such value fails, it is never lost."""
    rest = [c for c in records.columns if c != RECORD]
    parsed = F.variant_get(RECORD, "$", ddl(as_text(schema))).alias(RECORD)
    values = (F.col(RECORD).getField(f.name).cast(f.dataType).alias(f.name) for f in schema.fields)
    return records.select(parsed, *rest).select(*values, *rest)


def read_landing(
    spark: SparkSession, schema: T.StructType, paths: str | Sequence[str], pattern: str = FILE_PATTERN, with_files: bool = False
) -> DataFrame:
    """The records of `read_records` in the declared types; a number written as text is read as the number."""
    typed = typed_records(read_records(spark, paths, pattern), schema)
    return typed if with_files else typed.drop(*METADATA_COLUMNS)


def split_corrupt(records: DataFrame, misfits: Sequence[Misfit] = ()) -> tuple[DataFrame, DataFrame]:
    """Good records; and what could not be parsed or has no declared shape, with its file. From a read with ``quarantine``."""
    bad = F.col(CORRUPT).isNotNull()
    for path, kind, _ in misfits:
        bad = bad | _misshapen(path, kind)
    tagged = records.withColumn("bad", F.coalesce(bad, F.lit(False)))
    content = F.coalesce(F.col(CORRUPT), F.to_json(RECORD)).alias(CORRUPT)
    return tagged.filter("not bad").drop("bad", CORRUPT), tagged.filter("bad").select(content, *METADATA_COLUMNS)


def found_schema(found: str | None) -> T.DataType | None:
    """The type that `schema_of_variant_agg` states, objects as structs; None for no records."""
    if found is None or found == "VOID":
        return None
    return T.StructType.fromDDL(f"`{RECORD}` {found.replace('OBJECT<', 'STRUCT<')}")[RECORD].dataType


def undeclared(
    spark: SparkSession, schema: T.StructType, paths: str | Sequence[str], pattern: str = FILE_PATTERN, quarantine: bool = False
) -> T.StructType:
    """The declared schema with the fields the files have beyond it, as text, behind those of their object. Reads the files."""
    found = read_records(spark, paths, pattern, quarantine).agg(F.schema_of_variant_agg(RECORD)).head()[0]
    return grown(schema, found_schema(found))


def misfits(declared: T.DataType, found: T.DataType | None, path: tuple[str, ...] = ()) -> list[Misfit]:
    """Where some records hold no object or list although one is declared; nulls are neither."""
    if found is None or isinstance(found, T.NullType) or not isinstance(declared, (T.StructType, T.ArrayType)):
        return []
    if type(found) is not type(declared):
        return [(path, declared, found)]
    if isinstance(declared, T.ArrayType):
        return [(path, declared, found)] if misfits(declared.elementType, found.elementType) else []
    have = {f.name: f.dataType for f in found.fields}
    return [m for f in declared.fields for m in misfits(f.dataType, have.get(f.name), (*path, f.name))]


def _misshapen(path: tuple[str, ...], kind: T.DataType) -> Column:
    """Whether a record has neither null nor what is declared at the path."""
    there = F.try_variant_get(RECORD, variant_path(path), "variant")
    shape = "map<string, variant>" if isinstance(kind, T.StructType) else ddl(as_text(kind))
    return there.isNotNull() & ~F.is_variant_null(there) & F.try_variant_get(there, "$", shape).isNull()


def stream_files(spark: SparkSession, path: str, max_files_per_trigger: int = 1000, pattern: str = FILE_PATTERN) -> DataFrame:
    """Paths and sizes of new landed files as a stream, without their content."""
    reader = spark.readStream.format("binaryFile").schema(LISTING).options(pathGlobFilter=pattern, recursiveFileLookup=True)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).load(path).select(F.col("_metadata.file_path").alias("source_file_path"), "length")


def grown(declared: T.DataType, found: T.DataType | None) -> T.DataType:
    """A declared type with the fields that were found beyond it, as text, behind those of their object."""
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        have = {f.name: f.dataType for f in found.fields}
        own = [T.StructField(f.name, grown(f.dataType, have.get(f.name))) for f in declared.fields]
        return T.StructType(own + [T.StructField(n, as_text(k)) for n, k in have.items() if n not in declared.names])
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(grown(declared.elementType, found.elementType))
    return declared


def _arrays(partition_columns: Sequence[str]):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            groups = batch.groupby(list(partition_columns), sort=False, dropna=False) if partition_columns else [((), batch)]
            for values, rows in groups:
                cells = dict(zip(partition_columns, values, strict=True))
                yield pd.DataFrame([{**cells, "value": "[\n" + ",\n".join(rows["value"]) + "\n]"}])

    return write


def write_landing(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write each Arrow batch as a JSON array file; memory is bounded by the batch size.

    ``partition_by`` columns become directories and are left out of the records. The files appear
    when all are written, under names that the readers look for.
    """
    fields = [c for c in df.columns if c not in partition_by]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")
    rows = df.select(*(F.col(c).cast("string").alias(c) for c in partition_by), record)
    writer = rows.mapInPandas(_arrays(partition_by), rows.schema).write.option("maxRecordsPerFile", 1)
    writer.partitionBy(*partition_by).mode("append").format("text").option("compression", "none").save(path)


def landed_files(spark: SparkSession, path: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """One row per landed file, without reading its content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    meta = F.col("_metadata")
    return files.load(path).select(
        meta["file_path"].alias("source_file_path"),
        meta["file_size"].alias("length"),
        meta["file_modification_time"].alias("modified_at"),
    )


def unprocessed_files(listing: DataFrame, processed: DataFrame) -> DataFrame:
    """Listed files that no processed record came from."""
    done = processed.select("source_file_path").distinct()
    return listing.join(done, "source_file_path", "left_anti")
