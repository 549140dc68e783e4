"""Landed files as streams: nothing twice, nothing lost, same rows as in batch."""

import json
import time

import pytest

from pyspark.sql import functions as F

from assayflow.plans.pipeline import Pipeline
from assayflow.sources.landing import landed_files, unprocessed_files
from assayflow.sources.raw import write_raw
from assayflow.sources.registry import DATASETS
from assayflow.sources.tables import Table
from assayflow.streaming.ingest import batch_lineage, ingest_stream
from assayflow.streaming.merge import merge_batch, merge_newest_stream, merge_stream, newest_stream
from tests.lab_fixture import D1, D2, ingest, land


def run(spark, root, day=None):
    query = ingest_stream(spark, DATASETS["experiments"], str(root), "last_element", day)
    query.awaitTermination()
    return [p.numInputRows for p in query.recentProgress if p.numInputRows]


def test_new_files_only_and_skip_when_nothing_is_new(spark, tmp_path):
    land(tmp_path, D1)
    assert run(spark, tmp_path, D1) == [1]
    assert run(spark, tmp_path, D1) == []
    land(tmp_path, D2)
    assert run(spark, tmp_path, D2) == [1]
    raw = Pipeline(spark, str(tmp_path)).raw("experiments")
    assert raw.count() == 5
    lineage = batch_lineage(raw, "experiments").collect()
    assert len(lineage) == 2 and all(r.source_batch == r.batch_key for r in lineage)
    assert {r.source_file_name for r in raw.collect()} == {"06-00-00.json"}


def test_stream_equals_batch(spark, tmp_path):
    streamed, batch = tmp_path / "s", tmp_path / "b"
    land(streamed, D1)
    run(spark, streamed, D1)
    ingest(Pipeline(spark, str(batch)), batch, D1)
    rows = [
        sorted(map(str, Pipeline(spark, str(p)).raw("experiments").drop("source_batch", "source_file_path").collect()))
        for p in (streamed, batch)
    ]
    assert rows[0] == rows[1]


def test_ingest_day_defaults_to_the_clock_of_the_batch(spark, tmp_path):
    land(tmp_path, D1)
    run(spark, tmp_path)
    assert Pipeline(spark, str(tmp_path)).raw("experiments").filter(F.col("ingest_date") < F.current_date() - 1).count() == 0


def test_replayed_batch_is_written_once(spark, tmp_path):
    df = spark.range(5).withColumn("ingest_date", F.lit(D1))
    for _ in range(2):
        write_raw(df, f"{tmp_path}/raw", "b-1")
    write_raw(df, f"{tmp_path}/raw", "b-2")
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 10


def test_unprocessed_files(spark, tmp_path):
    land(tmp_path, D1)
    run(spark, tmp_path, D1)
    land(tmp_path, D2)
    listing = landed_files(spark, f"{tmp_path}/ingest/experiments")
    open_files = unprocessed_files(listing, Pipeline(spark, str(tmp_path)).raw("experiments")).collect()
    assert [f"run_date={D2}" in f.source_file_path for f in open_files] == [True]


def test_merge_stream_keeps_newest_and_survives_replay(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    order = lambda: [F.col("day").desc()]
    table = Table(spark, f"{tmp_path}/t", ["k"], buckets=2)

    def go():
        source = spark.readStream.schema("k int, day int").json(str(landing))
        merge_stream(source, table, order(), f"{tmp_path}/cp").awaitTermination()

    (landing / "1.json").write_text("\n".join(json.dumps({"k": k, "day": 5}) for k in (1, 2)))
    go()
    time.sleep(1)
    (landing / "2.json").write_text("\n".join(json.dumps(r) for r in ({"k": 1, "day": 3}, {"k": 2, "day": 9}, {"k": 3, "day": 1})))
    go()
    expected = [(1, 5), (2, 9), (3, 1)]
    assert sorted(map(tuple, table.read().collect())) == expected
    merge_batch(table, spark.createDataFrame([(1, 3), (2, 9)], "k int, day int"), order(), late_safe=True)
    assert sorted(map(tuple, table.read().collect())) == expected


def test_stored_records_are_skipped_on_request(spark, tmp_path):
    from assayflow.sources.raw import ingest_files

    paths = land(tmp_path, D1)["experiments"]
    again = tmp_path / "again.json"
    again.write_text(open(paths[0]).read())
    raw = lambda: Pipeline(spark, str(tmp_path)).raw("experiments")
    ds = DATASETS["experiments"]
    for file in (paths[0], str(again), str(again)):
        ingest_files(spark, ds, [file], str(tmp_path), D1, "last_element", skip_stored=True)
        assert raw().count() == 4
    ingest_files(spark, ds, land(tmp_path, D2)["experiments"], str(tmp_path), D2, "last_element", skip_stored=True)
    assert raw().count() == 5 and raw().select("record_hash").distinct().count() == 5
    ingest_files(spark, ds, [str(again)], str(tmp_path), D2, "last_element")
    assert raw().count() == 9


def test_fresh_checkpoint_keeps_other_files_and_reruns_change_nothing(spark, tmp_path):
    count = lambda: Pipeline(spark, str(tmp_path)).raw("experiments").count()
    land(tmp_path, D1)
    run(spark, tmp_path, D1)
    (tmp_path / "checkpoints").rename(tmp_path / "lost-1")
    land(tmp_path, D2)
    run(spark, tmp_path, D1)  # both files once more, in one batch of another content
    assert count() == 4 + 5
    (tmp_path / "checkpoints").rename(tmp_path / "lost-2")
    run(spark, tmp_path, D2)  # the same batch on a later day
    assert count() == 4 + 5


def test_bad_files_fail_or_go_to_quarantine(spark, tmp_path):
    from assayflow.sources.raw import ingest_files

    good = land(tmp_path, D1)["experiments"][0]
    bad = tmp_path / "bad.json"
    bad.write_text(open(good).read()[:-40])
    ds = DATASETS["experiments"]
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ|parse"):
        ingest_files(spark, ds, [good, str(bad)], str(tmp_path), D1, "last_element")
    ingest_files(spark, ds, [good, str(bad)], str(tmp_path), D1, "last_element", quarantine=True)
    raw = Pipeline(spark, str(tmp_path)).raw("experiments")
    assert raw.filter("id is null").count() == 0 and {r.source_file_name for r in raw.collect()} >= {good.rsplit("/", 1)[1]}
    kept = spark.read.parquet(f"{tmp_path}/quarantine/experiments").collect()
    assert kept and {r.source_file_name for r in kept} == {"bad.json"}


def test_a_change_in_an_undeclared_field_is_kept(spark, tmp_path):
    from assayflow.sources.raw import ingest_files, raw_schema, scan_raw, stored_schema

    ds = DATASETS["stocks"]
    for name, grade in (("a", None), ("b", "x"), ("c", "y"), ("d", "y")):
        record = {"id": "K1", "sample_id": "A1", "quantity": "12.5"} | ({"grade": grade} if grade else {})
        (tmp_path / f"{name}.json").write_text(json.dumps([record]))
        ingest_files(spark, ds, [f"{tmp_path}/{name}.json"], str(tmp_path), D1, "last_element", skip_stored=True)
    path = ds.raw_path(str(tmp_path))
    rows = scan_raw(spark, path, stored_schema(spark, path, raw_schema(spark, ds, "last_element"))).collect()
    assert sorted((r.quantity, r.grade or "") for r in rows) == [(12.5, ""), (12.5, "x"), (12.5, "y")]


def _stream(spark, folder):
    return spark.readStream.schema("k int, day int, note string").option("maxFilesPerTrigger", 1).json(str(folder))


def _land(folder, name, *rows):
    time.sleep(1.1)  # the source takes files by their times, in seconds
    (folder / f"{name}.json").write_text("\n".join(json.dumps(dict(zip(("k", "day", "note"), r))) for r in rows))


def test_state_lets_newer_versions_pass_only_also_after_a_restart(spark, tmp_path):
    landing, passed = tmp_path / "in", []
    landing.mkdir()

    def go():
        newest = newest_stream(_stream(spark, landing), ["k"], ["day"]).writeStream.outputMode("update")
        keep = lambda batch, _: passed.append(sorted(map(tuple, batch.collect()), key=str))
        newest.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()

    _land(landing, "1", (1, 5, "a"), (1, 4, "b"), (2, None, "c"), (None, 1, "d"))
    _land(landing, "2", (1, 3, "late"), (1, 5, "tie"), (2, 0, "newer than null"), (None, 1, "d"))
    go()
    _land(landing, "3", (1, 5, "tie"), (2, -1, "late"), (3, 1, "new"))
    go()
    _land(landing, "4", (1, 5, "a"), (2, 0, "newer than null"))
    go()
    assert passed == [[(1, 5, "a"), (2, None, "c"), (None, 1, "d")], [(2, 0, "newer than null")], [(3, 1, "new")], []]


def test_late_versions_rewrite_no_bucket(spark, tmp_path):
    landing, table = tmp_path / "in", Table(spark, f"{tmp_path}/t", ["k"], buckets=4)
    landing.mkdir()
    files = lambda: sorted(str(p) for p in (tmp_path / "t").rglob("*.parquet"))
    go = lambda cp="cp": merge_newest_stream(_stream(spark, landing), table, ["day"], f"{tmp_path}/{cp}").awaitTermination()
    _land(landing, "1", *[(k, 5, "first") for k in range(40)])
    go()
    before = files()
    _land(landing, "2", *[(k, 4, "late") for k in range(40)])
    go()
    assert files() == before
    _land(landing, "3", (7, 6, "newer"))
    go()
    expected = [(k, 6, "newer") if k == 7 else (k, 5, "first") for k in range(40)]
    assert sorted(map(tuple, table.read().collect())) == expected
    go("fresh")  # all files again, without the state: the stored versions compete
    assert sorted(map(tuple, table.read().collect())) == expected


def test_a_batch_that_failed_runs_again_with_its_versions(spark, tmp_path):
    landing, seen = tmp_path / "in", []
    landing.mkdir()
    _land(landing, "1", (1, 1, "a"), (2, 1, "b"))

    def go(fail):
        def keep(batch, _):
            seen.append(sorted(map(tuple, batch.collect())))
            if fail:
                raise RuntimeError("lost")

        newest = newest_stream(_stream(spark, landing), ["k"], ["day"]).writeStream.outputMode("update")
        newest.foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="lost"):
        go(True)
    go(False)
    assert seen == [[(1, 1, "a"), (2, 1, "b")]] * 2
