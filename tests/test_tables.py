import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from assayflow.operators.incremental import DuplicateKeyError
from assayflow.sources import passes
from assayflow.sources.raw import write_raw
from assayflow.sources.tables import DAY, LAYOUTS, Table


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("limit", [0, 100_000], ids=["shuffled", "broadcast"])
def test_merge_replaces_inserts_and_keeps(spark, tmp_path, limit):
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=4, broadcast_limit=limit)
    table.merge(spark.range(20).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    table.merge(spark.createDataFrame([(3, "new"), (50, "new"), (None, "n1")], "k bigint, v string"))
    table.merge(spark.createDataFrame([(None, "n2")], "k bigint, v string"))
    expected = [(i, "new" if i == 3 else "old") for i in range(20)] + [(50, "new"), (None, "n1"), (None, "n2")]
    assert rows(table.read()) == sorted(expected, key=str)


def test_merge_twice_changes_nothing_and_empty_update_is_harmless(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=3)
    data = spark.range(10).withColumnRenamed("id", "k")
    table.merge(data)
    table.merge(data)
    table.merge(data.filter("false"))
    assert rows(table.read()) == [(i,) for i in range(10)]


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=8)
    table.merge(spark.range(100).withColumnRenamed("id", "k"))
    table.merge(spark.createDataFrame([(5,)], "k bigint"))
    written = [p.name for p in (tmp_path / "t/data/v00000002").glob("key_bucket=*")]
    assert len(written) == 1 and table.read().count() == 100


def test_repeated_update_keys_are_refused_and_leave_the_table_alone(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"])
    repeated = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(DuplicateKeyError):
        table.merge(repeated)
    assert not table.exists()
    table.merge(repeated.distinct())
    with pytest.raises(DuplicateKeyError):
        table.merge(repeated)
    assert rows(table.read()) == [(1,)]


def test_first_merge_of_nothing_makes_an_empty_table(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"])
    table.merge(spark.createDataFrame([], "k int, v string"))
    assert table.exists() and table.read().dtypes == [("k", "int"), ("v", "string")] and table.read().count() == 0
    table.merge(spark.createDataFrame([(1, "a")], "k int, v string"))
    assert rows(table.read()) == [(1, "a")]


def test_overwrite_and_expire(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"])
    for n in (3, 5, 2):
        table.overwrite(spark.range(n))
    assert rows(table.read()) == [(0,), (1,)]
    table.expire(keep=1)
    assert [p.name for p in (tmp_path / "t/data").iterdir()] == ["v00000003"]
    assert rows(table.read()) == [(0,), (1,)]
    table.overwrite(table.read().filter("id = 1"))
    assert rows(table.read()) == [(1,)]


def test_reopening_with_other_buckets_or_keys_is_refused(spark, tmp_path):
    path, data = f"{tmp_path}/t", spark.range(20).withColumnRenamed("id", "k")
    Table(spark, path, ["k"], buckets=8).merge(data)
    with pytest.raises(ValueError, match="8 buckets"):
        Table(spark, path, ["k"], buckets=5).merge(data)
    with pytest.raises(ValueError, match="keyed by"):
        Table(spark, path, ["other"]).merge(data.withColumnRenamed("k", "other"))
    reopened = Table(spark, path, ["k"])
    reopened.merge(data)
    assert reopened.buckets == 8 and rows(reopened.read()) == sorted([(i,) for i in range(20)], key=str)


@pytest.mark.parametrize("limit", [0, 100_000], ids=["shuffled", "broadcast"])
def test_update_keys_of_another_type_match_and_new_columns_are_added(spark, tmp_path, limit):
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=3, broadcast_limit=limit)
    table.merge(spark.range(6).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    table.merge(spark.createDataFrame([(2, "new", 1.5), (9, "new", 2.5)], "k int, v string, w double"))
    assert table.read().dtypes == [("k", "bigint"), ("v", "string"), ("w", "double")]
    want = [(i, "new" if i == 2 else "old", 1.5 if i == 2 else None) for i in range(6)] + [(9, "new", 2.5)]
    assert rows(table.read()) == sorted(want, key=str)


def test_only_buckets_of_the_wanted_keys_are_read(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=8)
    table.merge(spark.range(100).withColumnRenamed("id", "k"))
    found = table.read_matching(spark.createDataFrame([(5,), (None,), (500,)], "k int"))
    assert rows(found) == [(5,)] and len(found.inputFiles()) <= 2


D = [dt.date(2024, 5, d) for d in range(1, 6)]


def facts(spark, *rows):
    return spark.createDataFrame([(*r,) for r in rows], "k string, v string, ingest_date date")


@pytest.mark.parametrize("limit", [0, 100_000], ids=["shuffled", "broadcast"])
def test_a_load_rewrites_only_the_days_that_hold_its_keys(spark, tmp_path, limit):
    make = lambda: Table(spark, f"{tmp_path}/t", ["k"], broadcast_limit=limit, layout="days")
    make().merge(facts(spark, ("a", "1", D[0]), ("b", "1", D[1]), ("c", "1", D[1]), ("d", "1", D[2]), (None, "n", None)))
    make().merge(facts(spark, ("e", "1", D[3]), ("f", "1", D[2])))  # new keys only: nothing is rewritten
    days = lambda version: {p.name.split("=")[1] for p in (tmp_path / f"t/data/v{version:08d}").glob("key_bucket=*")}
    assert days(2) == {str(D[3]), str(D[2])}
    make().merge(facts(spark, ("b", "2", D[4]), (None, "m", D[4])))
    assert days(3) == {str(D[1]), str(D[4])}
    want = [("a", "1", D[0]), ("b", "2", D[4]), ("c", "1", D[1]), ("d", "1", D[2]), ("e", "1", D[3]), ("f", "1", D[2])]
    want += [(None, "n", None), (None, "m", D[4])]
    assert rows(make().read()) == sorted(want, key=str)
    make().merge(facts(spark, ("c", "2", D[1])))
    assert days(4) == {str(D[1])}
    make().expire(keep=1)
    assert rows(make().read()) == sorted([("c", "2", D[1]) if r[0] == "c" else r for r in want], key=str)
    assert rows(make().read_matching(facts(spark, ("f", "", D[0]), ("x", "", D[0])))) == [("f", "1", D[2])]
    with pytest.raises(ValueError, match="laid out by days"):
        Table(spark, f"{tmp_path}/t", ["k"]).merge(facts(spark, ("z", "1", D[0])))
    with pytest.raises(DuplicateKeyError):
        make().merge(facts(spark, ("y", "1", D[0]), ("y", "2", D[1])))


def test_the_newest_day_is_published_and_right(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=2)
    stated = lambda: table._published()["newest"].get("day")
    table.merge(facts(spark, ("a", "1", D[1]), ("b", "1", None)))
    assert stated() == str(D[1]) and table.newest_day() == D[1]
    table.merge(facts(spark, ("c", "1", D[1]), ("d", "1", D[3])))
    assert stated() == str(D[3]) and table.newest_day() == D[3]
    table.merge(facts(spark, ("d", "2", D[0])))  # the newest day's only row moves back: not certain, so looked up
    assert stated() is None and table.newest_day() == D[1]
    table.overwrite(facts(spark, ("q", "1", D[2])))
    assert stated() == str(D[2])
    table.overwrite(facts(spark, ("q", "1", D[2])).filter("false"))
    assert table.newest_day() is None


def test_rows_that_are_not_approved_are_not_published(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", ["k"])

    def refuse(written):
        assert written.count() == 2
        raise RuntimeError("no")

    table.merge(facts(spark, ("a", "1", D[0])))
    for write in (table.merge, table.overwrite):
        with pytest.raises(RuntimeError, match="no"):
            write(facts(spark, ("b", "1", D[1])) if write == table.merge else facts(spark, ("b", "1", D[1]), ("c", "1", D[1])), refuse)
        assert rows(table.read()) == [("a", "1", D[0])]
    table.merge(facts(spark, ("b", "1", D[1])))
    assert rows(table.read()) == [("a", "1", D[0]), ("b", "1", D[1])]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_behind(spark, write):
    """Shuffle files that are there after a write and were not before; they are deleted in the background."""
    before, until = shuffle_files(spark), time.time() + 10
    write()
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


@pytest.mark.parametrize("layout", LAYOUTS)
def test_writes_leave_no_shuffle_files(spark, tmp_path, layout):
    table = Table(spark, f"{tmp_path}/t", ["k"], broadcast_limit=0, layout=layout)
    newest = lambda *days: facts(spark, *((f"k{i}", str(d), d) for i in range(40) for d in days)).groupBy("k").agg(F.max("v").alias("v"), F.max(DAY).alias(DAY))
    assert left_behind(spark, lambda: table.merge(newest(D[0], D[1]))) == set()
    assert left_behind(spark, lambda: table.merge(newest(D[2]).filter("k < 'k2'"))) == set()
    assert left_behind(spark, lambda: table.overwrite(newest(D[0], D[3]))) == set()
    assert left_behind(spark, lambda: write_raw(newest(D[0], D[3]), f"{tmp_path}/raw", "b", spread_by="k")) == set()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("layout", LAYOUTS)
def test_many_rows_are_merged_in_passes(spark, tmp_path, monkeypatch, layout):
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=5, broadcast_limit=0, layout=layout)
    old = [(None if i == 7 else f"k{i}", "old", D[i % 4]) for i in range(60)]
    new = [(None if i == 9 else f"k{i}", "new", D[4]) for i in range(0, 80, 3)]
    for i, batch in enumerate((old, new)):
        facts(spark, *batch).write.parquet(f"{tmp_path}/u{i}")
        parts = passes.in_passes(spark.read.parquet(f"{tmp_path}/u{i}"), "k")
        assert len(parts) == passes.MAX_PASSES and len([p for p in parts if p.count()]) > 1
        table.merge(parts)
    replaced = {r[0] for r in new} - {None}
    assert rows(table.read()) == sorted([r for r in old if r[0] not in replaced] + new, key=str)
    assert table.newest_day() == D[4] and not (tmp_path / "t/staged").exists()
    with pytest.raises(DuplicateKeyError):
        table.merge([facts(spark, ("z", "1", D[0])), facts(spark, ("z", "2", D[1]))])
    assert table.read().filter("k = 'z'").count() == 0
