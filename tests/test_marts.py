"""The marts against their plain left-join form, on random rows with a hot key."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from assayflow.plans.facts import fact_results
from assayflow.plans.marts import EXPERIMENT, candidate_mart, experiment_mart
from assayflow.plans.profiles import STRICT
from assayflow.plans.staging import RESULT_COLUMNS, stage_results
from assayflow.queries.lab import MODELS

CANDIDATES_DDL = (
    "sample_id string, sample_name string, internal_code string, antibody_clone_id string, "
    "antibody_target_antigen string, antibody_format string, antibody_humanized boolean, "
    "stock_id string, is_expired boolean, is_depleted boolean, ingest_date date"
)
RESULTS_DDL = (
    "sample_id string, stock_id string, experiment_id string, result_id string, assay_name string, "
    "instrument_name string, endpoint_name string, endpoint_value double, is_qc_pass boolean, ingest_date date"
)
ENDPOINTS = ["Binding Affinity", "Cytotoxicity", "IL-2", "IFN-gamma", "TNF-alpha", "Reporter Inhibition"]


def maybe(rng, value, p=0.1):
    return None if rng.random() < p else value


def day(rng):
    return dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(90))


def candidate_rows(rng):
    rows = []
    for i in range(40):
        sample = (maybe(rng, f"S{i}"), f"n{i % 7}", maybe(rng, "c"), f"cl{i}", None, "IgG", maybe(rng, True))
        for j in range(rng.randrange(4)):
            flags = (maybe(rng, rng.random() < 0.3), maybe(rng, rng.random() < 0.3))
            rows.append((*sample, f"K{i}-{j}", *flags, day(rng)))
        if rng.random() < 0.2:
            rows.append((*sample, None, None, None, None))
    return rows + rows[:5]  # repeated candidate rows too


def result_rows(rng, n=3000):
    rows = []
    for i in range(n):
        hot = rng.random() < 0.34  # one stock holds a third of all rows
        sample, stock = (7, 0) if hot else (rng.randrange(50), rng.randrange(4))
        ids = (maybe(rng, f"S{sample}", 0.02), maybe(rng, f"K{sample}-{stock}", 0.02))
        experiment = "E0" if hot else maybe(rng, f"E{rng.randrange(60)}", 0.05)
        values = (rng.choice(ENDPOINTS), maybe(rng, float(rng.randrange(100))), maybe(rng, rng.random() < 0.9))
        rows.append((*ids, experiment, maybe(rng, f"R{i}", 0.05), "a", "i", *values, day(rng)))
    return rows


def bag(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module", params=[1, 2])
def frames(request, spark):
    rng = random.Random(request.param)
    candidates = spark.createDataFrame(candidate_rows(rng) + [("S7", "n", "c", "cl", None, "IgG", True, "K7-0", False, False, day(rng))], CANDIDATES_DDL)
    return candidates, spark.createDataFrame(result_rows(rng), RESULTS_DDL)


def duck(name, kinds, rows):
    """Rows as a DuckDB table."""
    con = duckdb.connect()
    con.execute(f"create table {name} ({kinds.replace('string', 'varchar')})")
    con.executemany(f"insert into {name} values ({', '.join('?' * (kinds.count(',') + 1))})", rows)
    return con


def test_candidate_mart_equals_its_specification(spark, frames, tmp_path):
    candidates, results = frames
    con = duck("dim_antibody_candidates", CANDIDATES_DDL, [tuple(r) for r in candidates.collect()])
    con.execute(f"create table fct_screening_results ({RESULTS_DDL.replace('string', 'varchar')})")
    con.executemany("insert into fct_screening_results values (?, ?, ?, ?, ?, ?, ?, ?, ?, ?)", [tuple(r) for r in results.collect()])
    cursor = con.execute(MODELS["mart_antibody_candidate_summary"])
    names = [d[0] for d in cursor.description]
    want = sorted(str(tuple(row[i] for i in sorted(range(len(names)), key=lambda i: names[i]))) for row in cursor.fetchall())
    assert bag(candidate_mart(candidates, results)) == want


def test_untested_candidate_is_for_review(spark, frames):
    candidates = frames[0].filter("sample_id = 'S7'").withColumn("sample_id", F.lit("untested"))
    row = candidate_mart(candidates, frames[1]).filter("internal_code = 'c'").head()
    assert row.num_available_stocks > 0 and row.num_screening_results == 0 and row.qc_pass_rate is None
    assert row.candidate_recommendation == "Review QC"


def test_candidate_mart_needs_no_window(frames):
    plan = candidate_mart(*frames)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Expand" not in plan.split("Join LeftOuter")[0]


def test_experiment_mart_keeps_fanout_and_unmatched(spark, frames):
    results = frames[1]
    experiments = spark.sql("""
        select if(id = 70, null, concat('E', id)) experiment_id, 'n' experiment_name, 'p' project, 's' experiment_status,
            date'2024-02-10' run_date, 'a' experiment_author, 'p' protocol_name, 'c' protocol_code, 'v' protocol_version,
            timestamp_ntz'2024-01-01' created_at, cast(null as timestamp_ntz) signed_at,
            cast(null as timestamp_ntz) witnessed_at, id % 2 = 0 is_signed, id % 4 = 0 is_witnessed,
            if(id % 3 = 0, 8L, null) days_created_to_signed, cast(null as bigint) days_signed_to_witnessed,
            date'2024-03-01' ingest_date
        from range(71)""")
    mart = experiment_mart(experiments, results)
    plain = experiments.join(results.drop("ingest_date"), "experiment_id", "left")
    columns = ["experiment_id", "result_id", "sample_id", "stock_id", "endpoint_name", "is_qc_pass", "is_signed"]
    assert bag(mart.select(*columns)) == bag(plain.select(*columns))
    status = {(r.is_signed, r.is_witnessed): r.compliance_status for r in mart.collect()}
    assert status == {
        (True, True): "Complete", (True, False): "Signed Not Witnessed", (False, False): "Unsigned",
    }
    on_time = {(r.is_signed and r.is_witnessed, r.days_created_to_signed, r.is_compliance_complete_within_7_days) for r in mart.collect()}
    assert on_time == {(True, 8, False), (True, None, True), (False, 8, False), (False, None, False)}


def test_staged_results_are_shuffled_once_for_both_sides_of_the_mart(spark):
    columns = [spec.split()[0] for spec in RESULT_COLUMNS]
    numbers = ("endpoint_value", "treatment_concentration", "replicate_number", "measurement_timepoint_hours")
    kinds = {c: "double" if c in numbers else "boolean" if c == "antibody_humanized" else "string" for c in columns} | {"ingest_date": "date"}
    row = {c: 1.0 if kinds[c] == "double" else True if kinds[c] == "boolean" else c for c in columns}
    days = [{**row, "ingest_date": dt.date(2024, 1, d), "experiment_id": f"E{d}"} for d in (1, 2)]
    raw = spark.createDataFrame([tuple(d[c] for c in columns) for d in days], ", ".join(f"{c} {k}" for c, k in kinds.items()))
    experiments = spark.createDataFrame([(f"E{d}", None) for d in (1, 2, 3)], "experiment_id string, run_date date")
    missing = {c: F.lit(None).cast("boolean" if c.startswith("is_") else "string") for c in (*EXPERIMENT, "ingest_date") if c not in ("experiment_id", "run_date", "run_month")}
    mart = experiment_mart(experiments.withColumns(missing), fact_results(stage_results(raw, STRICT)))
    assert {(r.experiment_id, r.result_id) for r in mart.collect()} == {("E1", None), ("E2", "result_id"), ("E3", None)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = mart.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    dealt = [line for line in plan if "Exchange hashpartitioning(result_id" in line]
    assert len(dealt) == 2 and sum("ReusedExchange" in line for line in dealt) == 1
