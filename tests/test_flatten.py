import json

import pytest
from pyspark.sql import functions as F

from assayflow.operators.flatten import flatten
from assayflow.sources.landing import read_landing
from assayflow.sources.registry import DATASETS


def rows(df):
    return [r.asDict() for r in df.collect()]


def record(spark, ddl, *values):
    lines = spark.createDataFrame([(json.dumps(v),) for v in values], "j string")
    return lines.select(F.from_json("j", ddl).alias("r")).select("r.*")


def test_leaf_names_and_union_over_absent_objects(spark):
    df = record(spark, "a struct<id: int>, b struct<x: struct<y: string>>, z int", {"a": {"id": 1}}, {"z": 2})
    assert rows(flatten(df)) == [{"id": 1, "y": None, "z": None}, {"id": None, "y": None, "z": 2}]


def test_later_leaf_wins_in_document_order(spark):
    df = record(spark, "v int, b struct<v: int>, a struct<v: int>", {"v": 1, "b": {"v": 2}, "a": {"v": 3}})
    assert rows(flatten(df)) == [{"v": 3}]


def test_absent_object_keeps_earlier_value_and_present_null_replaces_it(spark):
    df = record(spark, "v int, b struct<v: int>", {"v": 1}, {"v": 1, "b": {"v": None}})
    assert rows(flatten(df)) == [{"v": 1}, {"v": None}]


def test_list_last_element_wins_and_empty_list_adds_nothing(spark):
    ddl = "id string, items array<struct<id: string, n: int>>"
    df = record(
        spark, ddl, {"id": "a", "items": [{"id": "b", "n": 1}, {"id": "c", "n": 2}]}, {"id": "a", "items": []}, {"id": "a"}
    )
    assert rows(flatten(df)) == [{"id": "c", "n": 2}, {"id": "a", "n": None}, {"id": "a", "n": None}]


def test_lists_of_scalars_and_nested_lists(spark):
    df = record(
        spark,
        "tags array<int>, grid array<array<int>>, l array<struct<deep: struct<k: int>, more: array<int>>>",
        {"tags": [1, 2], "grid": [[1], [2, 3], []], "l": [{"deep": {"k": 5}, "more": [7]}, {"more": []}]},
    )
    assert rows(flatten(df)) == [{"tags": 2, "grid": 3, "k": 5, "more": 7}]


def test_other_rules(spark):
    df = record(spark, "v int, b struct<v: int>, l array<int>", {"v": 1, "b": {"v": 2}, "l": [1, 2]})
    assert rows(flatten(df, on_collision="prefix", arrays="keep")) == [{"v": 1, "b_v": 2, "l": [1, 2]}]
    with pytest.raises(ValueError, match="b.v"):
        flatten(df, on_collision="error")
    with pytest.raises(ValueError):
        flatten(df, arrays="first")


def test_plan_needs_no_shuffle_and_no_python(spark):
    df = spark.createDataFrame([], DATASETS["screening_results"].landing_schema)
    plan = flatten(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_flattening_does_not_depend_on_the_number_of_files(spark, tmp_path):
    schema = DATASETS["stocks"].landing_schema
    stocks = [{"id": f"K{i}", "sample_id": f"S{i}", "quantity": float(i)} for i in range(6)]
    for name, groups in {"one": [stocks], "many": [[s] for s in stocks]}.items():
        (tmp_path / name).mkdir()
        for i, group in enumerate(groups):
            (tmp_path / name / f"{i}.json").write_text(json.dumps(group, indent=2))
        (tmp_path / name / "notes.txt").write_text("not json")
    one, many = (sorted(map(str, rows(flatten(read_landing(spark, schema, f"{tmp_path}/{n}"))))) for n in ("one", "many"))
    assert one == many and len(one) == 6
