"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as driver
from assayflow.queries import QUERIES, SQL
from tests.oracle import differences


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []


def test_every_query_has_sql_and_the_entry_runs(spark):
    assert QUERIES.keys() == SQL.keys()
    assert driver.queries().keys() >= QUERIES.keys()
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["candidate_mart_strict", "experiment_mart_strict", "dq_unique", "design_grid"])
def test_plan_has_no_cross_join_and_no_python(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in text for bad in ("CartesianProduct", "NestedLoop", "Python", "ArrowEval"))


def test_scan_reads_only_the_columns_it_needs(spark, sf_dir):
    text = QUERIES["rank_by_average"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text


def test_all_outcomes_occur(spark, sf_dir):
    marts = {name: QUERIES[name](spark, sf_dir) for name in ("candidate_mart", "experiment_mart")}
    values = lambda mart, column: {r[0] for r in marts[mart].select(column).distinct().collect()}
    assert values("candidate_mart", "candidate_recommendation") == {"Advance", "Hold", "Review QC"}
    assert values("experiment_mart", "compliance_status") == {"Complete", "Signed Not Witnessed", "Unsigned"}
    assert values("experiment_mart", "qc_status") <= {"QC Pass", "QC Fail", "No Result"}
