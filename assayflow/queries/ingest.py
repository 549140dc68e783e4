"""Landing, flattening and raw tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.operators.flatten import flatten, flatten_variant
from assayflow.operators.keys import batch_keys, composite_key, new_records, record_hash
from assayflow.operators.schema import union_evolving
from assayflow.queries.base import query, table
from assayflow.sources.landing import landed_files, object_key, read_landing, unprocessed_files, write_landing
from assayflow.sources.paths import scratch_dir
from assayflow.sources.raw import PARTITIONS, ingest_files, raw_schema, scan_raw, stored_schema, write_raw
from assayflow.sources.registry import Dataset
from assayflow.streaming.ingest import batch_lineage, ingest_stream

EVENT_DDL = "event_id bigint, ts string, user_id bigint, event_type string, value double, props struct<k: int>"
RUN_DAY = date(2024, 2, 1)


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested records, with timestamps as text."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("string").alias("ts"),
        "user_id",
        "event_type",
        "value",
        F.from_json("props", "k int").alias("props"),
        F.col("ts").cast("date").alias("run_date"),
    )


def land_events(spark: SparkSession, sf_dir: str, by_day: bool = False, path: str | None = None) -> str:
    """Export all events as JSON array files and return their folder."""
    path = path or scratch_dir(spark, "landing")
    records = event_records(spark, sf_dir)
    write_landing(records if by_day else records.drop("run_date"), path, ["run_date"] if by_day else [])
    return path


def event_schema() -> T.StructType:
    return T.StructType.fromDDL(EVENT_DDL)


def typed_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


FLAT_EVENTS = """
select event_id, ts, user_id, event_type, value, cast(json_extract(props, '$.k') as int) as k from events"""


@query(FLAT_EVENTS)
def ingest_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = read_landing(spark, event_schema(), land_events(spark, sf_dir))
    return typed_ts(flatten(landed))


@query(f"""
select event_id, cast(ts as date) as run_date, true as key_ends_with_name, date '{RUN_DAY}' as ingest_date from events""")
def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with the day folder of the file it came from, which must be the day of its event."""
    landed = read_landing(spark, event_schema(), land_events(spark, sf_dir, by_day=True), with_files=True)
    key = object_key(F.col("source_file_path"))
    day = F.regexp_extract(key, r"run_date=(\d{4}-\d{2}-\d{2})/", 1).cast("date")
    named = key.endswith(F.col("source_file_name")) & (F.length("source_file_name") > 0)
    return landed.select(
        "event_id", day.alias("run_date"), named.alias("key_ends_with_name"), F.lit(RUN_DAY).alias("ingest_date")
    )


@query("select *, cast(ts as date) as ingest_date from events")
def raw_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "raw")
    events = table(spark, sf_dir, "events")
    tagged = events.withColumn("ingest_date", F.col("ts").cast("date"))
    for _ in range(2):  # the second write of the same batch replaces the first
        write_raw(tagged, path, "batch-1")
    schema = T.StructType(events.schema.fields + PARTITIONS.fields)
    return scan_raw(spark, path, schema).drop("source_batch")


@query("""
select o_orderkey, o_orderstatus, o_totalprice, null::varchar as o_orderpriority from orders
where o_orderstatus = 'O'
union all
select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders where o_orderstatus <> 'O'""")
def schema_evolution_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    older = orders.filter("o_orderstatus = 'O'").drop("o_orderpriority")
    newer = orders.filter("o_orderstatus <> 'O'")
    return union_evolving([older, newer], older.schema)


@query("""
select event_id, user_id, event_type, value, cast(json_extract(props, '$.k') as int) as k from events""")
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct("user_id").alias("who"),
        F.struct("event_type", F.struct("value", F.from_json("props", "k int").alias("props")).alias("data")).alias("what"),
    )
    return flatten(nested)


@query("""
select event_id, case event_type when 'signup' then value when 'purchase' then null
    else cast(json_extract(props, '$.k') as double) end as value
from events""")
def flatten_collision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose later leaf has a value, is an explicit null (purchases) or absent (signups, alternately with its object)."""
    events = table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k double").getField("k"))
    event, empty = F.col("event_type"), F.create_map().cast("map<string, double>")
    measured = (
        F.when(event == "purchase", F.create_map(F.lit("value"), F.lit(None).cast("double")))
        .when(event != "signup", F.create_map(F.lit("value"), F.col("k")))
        .when(F.col("event_id") % 2 == 0, empty)
    )
    record = events.select("event_id", F.parse_json(F.to_json(F.struct("value", measured.alias("measured")))).alias("record"))
    return flatten_variant(record, "record", T.StructType.fromDDL("value double, measured struct<value: double>"))


@query("""
select doc_id, coalesce(lines[-1], lang) as value, cast(nullif(len(lines), 0) as int) as position
from (
    select doc_id, lang, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[0-9]')] as lines
    from documents
)""")
def flatten_list_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_digit = F.filter(F.split("text", "\n"), lambda x: x.rlike("[0-9]"))
    numbered = F.transform(with_digit, lambda x, i: F.struct(x.alias("value"), (i + 1).alias("position")))
    record = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("value"), numbered.alias("lines"))
    return flatten(record)


@query("""
select o_orderkey, substring(sha256(to_json({
        'o_custkey': o_custkey, 'o_orderkey': o_orderkey, 'o_orderpriority': o_orderpriority,
        'o_orderstatus': case when o_orderstatus <> 'P' then o_orderstatus end})), 1, 12) as record_hash,
    o_orderkey || '|' || o_custkey as composite_key
from orders""", name="record_hash")
def record_hash_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
    )
    return orders.select(
        "o_orderkey",
        record_hash(orders).alias("record_hash"),
        composite_key(F.col("o_orderkey"), F.col("o_custkey")).alias("composite_key"),
    )


@query("""
select distinct l_orderkey as id, l_returnflag as record_hash from lineitem
where not exists (
    select 1 from orders where o_orderkey = l_orderkey
        and l_returnflag = case o_orderstatus when 'F' then 'R' when 'O' then 'N' else 'A' end)""")
def new_records_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("record_hash")
    )
    status = F.col("o_orderstatus")
    stored = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(status == "F", "R").when(status == "O", "N").otherwise("A").alias("record_hash"),
    )
    return new_records(incoming, stored)


@query("""
select source, doc_id // 1000 as batch, count(*) as n_files,
    sha256(source || '|' || string_agg('doc-' || doc_id, '|' order by 'doc-' || doc_id)) as batch_key
from documents group by source, doc_id // 1000""")
def batch_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One batch covers a thousand ids, so it never holds more than a thousand files.
    files = table(spark, sf_dir, "documents").select(
        "source",
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("path"),
        F.floor(F.col("doc_id") / 1000).alias("batch"),
    )
    return batch_keys(files, "source", "path", ["batch"])


EVENTS = Dataset("events", EVENT_DDL, "event_id")


def ingest_events(spark: SparkSession, sf_dir: str, max_files: int, by_day: bool = False) -> str:
    """Land all events and take them to a raw table as the shipped stream does; the root of both."""
    root = scratch_dir(spark, "lake")
    land_events(spark, sf_dir, by_day, EVENTS.landing_path(root))
    ingest_stream(spark, EVENTS, root, "last_element", RUN_DAY, max_files_per_trigger=max_files).awaitTermination()
    return root


def raw_event_schema(spark: SparkSession) -> T.StructType:
    return raw_schema(spark, EVENTS, "last_element")


@query(FLAT_EVENTS)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scan_raw(spark, EVENTS.raw_path(ingest_events(spark, sf_dir, 4)), raw_event_schema(spark))
    return typed_ts(raw).select("event_id", "ts", "user_id", "event_type", "value", "k")


@query("""
select source_batch = batch_key as named_by_content, n_files > 0 and n_files <= 4 as within_limit, n_records
from (select true as named, count(*) as n_records from events), (select 'x' as source_batch, 'x' as batch_key, 1 as n_files)""")
def stream_batch_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of the shipped stream: each named by the key of the files its rows came from, and what they hold together."""
    raw = scan_raw(spark, EVENTS.raw_path(ingest_events(spark, sf_dir, 4)), raw_event_schema(spark))
    held = raw.groupBy("source_batch").agg(F.count("*").alias("n_records"))
    lineage = batch_lineage(raw, EVENTS.name).join(held, "source_batch")
    named = (F.col("source_batch") == F.col("batch_key")).alias("named_by_content")
    within = ((F.col("n_files") > 0) & (F.col("n_files") <= 4)).alias("within_limit")
    return lineage.groupBy(named, within).agg(F.sum("n_records").alias("n_records"))


@query("""
select cast(ts as date) as run_date, count(*) as n_records from events where ts >= timestamp '2024-01-16' group by all""",
       name="unprocessed_files")
def unprocessed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the files still to be processed hold, per day folder."""
    landing = land_events(spark, sf_dir, by_day=True)
    day = F.regexp_extract("source_file_path", r"run_date=(\d{4}-\d{2}-\d{2})", 1).cast("date")
    landed = read_landing(spark, event_schema(), landing, with_files=True)
    processed = landed.filter(day < F.lit("2024-01-16").cast("date"))
    open_files = unprocessed_files(landed_files(spark, landing), processed).select("source_file_path")
    rows = landed.join(open_files, "source_file_path", "left_semi")
    return rows.groupBy(day.alias("run_date")).agg(F.count("*").alias("n_records"))


@query("""
select event_id, event_type, cast(cast(user_id as double) + 0.5 as double) as value, source from (
    select event_id, event_type, user_id, case when event_id % 2 = 0 then 'kit-' || user_id end as source from events)""")
def ingest_new_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the records have a field that no schema declares, and all have their number as text; nothing is lost."""
    events = table(spark, sf_dir, "events")
    kit = F.concat(F.lit("kit-"), F.col("user_id").cast("string"))
    half = (F.col("user_id").cast("double") + 0.5).cast("string")
    root, kits = scratch_dir(spark, "lake"), Dataset("kits", "event_id bigint, event_type string, value double", "event_id")
    path = kits.landing_path(root)
    plain = events.select("event_id", "event_type", half.alias("value"))
    write_landing(plain.filter("event_id % 2 <> 0"), path)
    write_landing(plain.join(events.select("event_id", kit.alias("source")), "event_id").filter("event_id % 2 = 0"), path)
    ingest_files(spark, kits, [path], root, RUN_DAY, "last_element")
    raw = kits.raw_path(root)
    stored = scan_raw(spark, raw, stored_schema(spark, raw, raw_schema(spark, kits, "last_element")))
    return stored.select("event_id", "event_type", "value", "source")
