import hashlib
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.operators import catalogue, keys, quality
from assayflow.operators.dedup import dedup
from assayflow.operators.incremental import since_high_water, upsert, upsert_newest
from assayflow.operators.joins import left_join_fanout, orphans
from assayflow.operators.quality import Check, run_checks
from assayflow.operators.schema import conform, merge_schemas, schema_changes, union_evolving


def bag(df):
    return sorted(map(str, (r.asDict(True) for r in df.select(*sorted(df.columns)).collect())))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_does_not_depend_on_row_order(spark):
    versions = [(i % 3, i // 3 % 2, f"v{i % 5}", [i]) for i in range(30)]
    pick = lambda data: bag(dedup(spark.createDataFrame(data, "k int, day int, v string, l array<int>"), ["k"], [F.col("day").desc()]))
    assert pick(versions) == pick(versions[::-1]) == pick(versions[7:] + versions[:7])


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    text = plan(dedup(df, ["k"], [F.col("id").desc()]))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_fanout_join_equals_left_join_with_a_hot_key(spark):
    left = spark.createDataFrame([(k, f"l{k}") for k in (1, 2, 3, None)], "k int, l string")
    right = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 1), (2, 2), (9, 9), (None, 5)], "k int, r int")
    assert bag(left_join_fanout(left, right, ["k"])) == bag(left.join(right, "k", "left"))


def test_fanout_join_lets_adaptive_execution_split_the_hot_key(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(1000).select(F.col("id").alias("k"), F.lit("l").alias("l"))
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900)
        right = spark.range(0, 60000, 1, 16).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("r"))
        plain, split = left.join(right, "k", "left"), left_join_fanout(left, right, ["k"])
        assert plain.count() == split.count() > 60000
        plain.collect(), split.collect()
        assert "skew=true" not in plan(plain)
        assert "skew=true" in plan(split)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_orphans_count_rows_and_pass_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,)], "id int")
    assert bag(orphans(child, ["fk"], parent, ["id"])) == ["{'fk': 2, 'n_rows': 2}"]


def test_record_hash_is_the_digest_of_sorted_compact_json(spark):
    record = {"b": "x/é\"", "a": 1, "c": None, "n": {"z": True, "y": [1.5, 2.0]}}
    df = spark.createDataFrame([json.dumps(record)], "string").select(
        F.from_json("value", "b string, a int, c string, n struct<z: boolean, y: array<double>>").alias("r")
    ).select("r.*")
    text = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert df.select(keys.record_hash(df)).head()[0] == hashlib.sha256(text.encode()).hexdigest()[:12]


def test_new_records_are_unique_and_unknown(spark):
    incoming = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2"), ("b", "1")], "id string, record_hash string")
    stored = spark.createDataFrame([("a", "2"), ("c", "1")], "id string, record_hash string")
    assert bag(keys.new_records(incoming, stored)) == ["{'id': 'a', 'record_hash': '1'}", "{'id': 'b', 'record_hash': '1'}"]


def test_batch_key_does_not_depend_on_path_order(spark):
    paths = ["s3://b/2.json", "s3://b/1.json"]
    files = spark.createDataFrame([("samples", 7, p) for p in paths], "dataset string, batch int, path string")
    row = keys.batch_keys(files, "dataset", "path", ["batch"]).head()
    expected = hashlib.sha256(b"samples|s3://b/1.json|s3://b/2.json").hexdigest()
    assert row.batch_key == keys.batch_key("samples", paths) == expected and row.n_files == 2


def test_conform_and_changes(spark):
    schema = T.StructType.fromDDL("a int, b string, c double")
    df = spark.createDataFrame([(2.6, 1, "new")], "a double, c int, d string")
    assert conform(df, schema).dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert conform(df, schema).head().asDict() == {"a": 3, "b": None, "c": 1.0}
    assert schema_changes(df, schema) == {"added": ["d"], "deleted": ["b"], "retyped": ["a", "c"]}
    assert merge_schemas(schema, df.schema).fieldNames() == ["a", "b", "c", "d"]
    assert union_evolving([df, df.drop("d")], schema).columns == ["a", "b", "c", "d"]


def test_upsert_replaces_inserts_and_never_matches_null(spark):
    ddl = "k int, v string"
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], ddl)
    updates = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], ddl)
    wanted = bag(spark.createDataFrame([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], ddl))
    assert bag(upsert(target, updates, ["k"])) == wanted
    assert bag(upsert(target, updates, ["k"], broadcast_keys=True)) == wanted


def test_upsert_newest_keeps_the_newer_version(spark):
    ddl = "k int, day int"
    target, late = spark.createDataFrame([(1, 5), (2, 1)], ddl), spark.createDataFrame([(1, 3), (2, 2)], ddl)
    merged = upsert_newest(target, late, ["k"], [F.col("day").desc()])
    assert bag(merged) == bag(spark.createDataFrame([(1, 5), (2, 2)], ddl))


def test_high_water_filter_is_inclusive_and_empty_target_gives_nothing(spark):
    source = spark.createDataFrame([(d,) for d in (1, 2, 3)], "ingest_date int")
    assert since_high_water(source, source.filter("ingest_date < 3")).count() == 2
    assert since_high_water(source, source.filter("false")).count() == 0


def test_filter_before_dedup_equals_dedup_before_filter(spark):
    df = spark.range(400).select((F.col("id") % 37).alias("k"), F.pmod(F.hash("id"), F.lit(9)).alias("ingest_date"), "id")
    order = [F.col("ingest_date").desc()]
    for mark in range(9):
        late = F.col("ingest_date") >= mark
        assert bag(dedup(df.filter(late), ["k"], order)) == bag(dedup(df, ["k"], order).filter(late))


def test_high_water_mark_prunes_partitions(spark, tmp_path):
    path = f"{tmp_path}/raw"
    spark.range(10).withColumn("ingest_date", F.col("id") % 5).write.partitionBy("ingest_date").parquet(path)
    raw = spark.read.parquet(path)
    pruned = since_high_water(raw, spark.createDataFrame([(3,)], "ingest_date int"))
    assert pruned.count() == 4
    scan = [line for line in plan(pruned).splitlines() if "FileScan" in line and path in line][0]
    assert "ingest_date" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_checks_count_failures(spark):
    t = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "z", None), (None, None, 1)], "id int, c string, n int")
    p = spark.createDataFrame([(1,)], "id int")
    checks = [
        Check("t", "id", "not_null"),
        Check("t", "id", "unique"),
        Check("t", "c", "accepted_values", values=("a", "b")),
        Check("t", "id", "relationships", parent="p", parent_column="id"),
        Check("t", "n", "expression", expression="n <= id"),
        Check("p", "id", "unique"),
    ]
    got = {(r.table, r.column, r.check): (r.failures, r.status) for r in run_checks({"t": t, "p": p}, checks).collect()}
    assert got == {
        ("t", "id", "not_null"): (1, "fail"),
        ("t", "id", "unique"): (1, "fail"),
        ("t", "c", "accepted_values"): (1, "fail"),
        ("t", "id", "relationships"): (1, "fail"),
        ("t", "n", "expression"): (1, "fail"),
        ("p", "id", "unique"): (0, "pass"),
    }


def test_status_mismatches(spark):
    df = spark.sql("""select * from values ('Witnessed', 1, 1), ('Signed', 1, null), ('Draft', null, null),
        ('In Review', null, null), ('Draft', 1, null), (null, 1, 1) as t(experiment_status, signed_at, witnessed_at)""")
    assert quality.status_mismatches(df).count() == 2


def test_catalogue_grid_and_ranges(spark):
    runs = spark.createDataFrame([("ICI-1003",), ("ICI-1004",), ("ICI-1005",), ("ICI-1006",), ("ICI-1009",), ("X",)], "protocol_code string")
    counts = {r[0]: r[1] for r in catalogue.measurement_grid(runs).groupBy("protocol_code").count().collect()}
    assert counts == {"ICI-1003": 12, "ICI-1004": 48, "ICI-1005": 36, "ICI-1006": 30, "ICI-1009": 2}
    values = spark.createDataFrame([("ICI-1005", 4.9), ("ICI-1005", 5.0), ("ICI-1009", 500.5), ("X", -1.0)], "protocol_code string, endpoint_value double")
    assert catalogue.out_of_range(values).count() == 2
    assert "CartesianProduct" not in plan(catalogue.measurement_grid(runs))
