"""Landed files through all models, in both profiles."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from assayflow.operators.quality import ChecksFailed, run_checks
from assayflow.plans.checks import declared_checks
from assayflow.plans.pipeline import Pipeline
from assayflow.plans.profiles import COMPAT, PROFILES, STRICT
from assayflow.sources import passes
from assayflow.streaming.ingest import batch_lineage
from tests.lab_fixture import AS_OF, D1, D2, RUN, ingest


@pytest.fixture(scope="module", params=["compat", "strict"])
def built(request, spark, tmp_path_factory):
    root = tmp_path_factory.mktemp(request.param)
    pipeline = Pipeline(spark, str(root), PROFILES[request.param], buckets=2)
    for day in (D1, D2):
        ingest(pipeline, root, day)
        pipeline.build(RUN, AS_OF)
        if day == D1:
            first = pipeline.table("dim_experiments").read().filter("experiment_id = 'E1'").head()
            assert first.experiment_status == "Draft"
    return pipeline


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_staged_and_merged_values(built):
    samples = by(built.table("dim_samples").read(), "sample_id")
    assert samples["A1"].sample_name == "Alpha Sample"
    assert samples["C1"].cell_line_passage_number == 7 and samples["C1"].pbmc_donor_id is None
    experiments = by(built.table("dim_experiments").read(), "experiment_id")
    assert experiments["E1"].experiment_status == "Signed" and experiments["E1"].ingest_date == D2
    days = {k: (r.days_created_to_signed, r.days_signed_to_witnessed) for k, r in experiments.items()}
    assert days == {"E1": (1, None), "E2": (3, 7), "E3": (7, 8), "E4": (None, None)}
    assert {r.dbt_updated_at for r in experiments.values()} == {RUN}


def test_candidate_dimension(built):
    rows = by(built.table("dim_antibody_candidates").read(), "stock_id")
    state = {k: (r.is_expired, r.is_depleted, r.days_until_expiry) for k, r in rows.items()}
    assert state == {
        "K1": (False, False, 5),
        "K2": (False, True, 5),
        "K3": (True, False, -1),
        "K4": (False, False, None),
        None: (None, None, None),
    }
    assert rows[None].sample_id == "A2" and rows[None].ingest_date is None and rows["K1"].ingest_date == D1


def test_fact_grain(built):
    facts = built.table("fct_screening_results").read()
    ids = {(r.result_id, r.replicate_number): (r.sample_id, r.stock_id, r.endpoint_value) for r in facts.collect()}
    if built.profile is COMPAT:
        assert ids == {("R1", 1): ("A1", "K1", 40.0), ("R2", 1): ("C1", "KC", 80.0)}
    else:
        assert ids == {("R1", 1): ("A1", "K1", 40.0), ("R1", 2): ("A1", "K1", 60.0), ("R2", 1): ("A1", "K1", 80.0)}
        raw = built.raw("screening_results").filter("result_id = 'R2'").head()
        assert [m.stock_id for m in raw.supporting_materials] == ["KP", "KC"]


def test_candidate_mart(built):
    rows = by(built.table("mart_antibody_candidate_summary").read(), "sample_id")
    a1, a2 = rows["A1"], rows["A2"]
    assert (a1.num_available_stocks, a1.num_usable_stocks) == (4, 2)
    tested = (a1.num_experiments, a1.num_stocks_tested, a1.num_screening_results)
    averages = (a1.avg_binding_affinity_nm, a1.avg_cytotoxicity_percent, a1.qc_pass_rate)
    if built.profile is COMPAT:
        assert tested == (1, 1, 1) and averages == (40.0, None, 1.0) and a1.candidate_recommendation == "Hold"
    else:
        assert tested == (2, 1, 3) and averages == (50.0, 80.0, 1.0) and a1.candidate_recommendation == "Advance"
    assert (a2.num_available_stocks, a2.num_screening_results, a2.qc_pass_rate) == (0, 0, None)
    assert a2.candidate_recommendation == "Review QC"
    assert (a1.latest_candidate_ingest_date, a2.latest_candidate_ingest_date) == (D1, None)


def test_experiment_mart(built):
    rows = built.table("mart_experiment_summary").read().collect()
    assert len(rows) == (4 if built.profile is COMPAT else 5)
    got = {r.experiment_id: (r.compliance_status, r.is_compliance_complete_within_7_days, r.qc_status) for r in rows}
    assert got == {
        "E1": ("Signed Not Witnessed", False, "No Result"),
        "E2": ("Complete", True, "QC Pass"),
        "E3": ("Complete", False, "QC Pass"),
        "E4": ("Unsigned", False, "No Result"),
    }
    assert {r.run_month for r in rows} == {dt.date(2024, 1, 1)}


def test_declared_checks(built):
    checks = declared_checks()
    kinds = {k: sum(c.kind == k for c in checks) for k in {c.kind for c in checks}}
    assert kinds == {"not_null": 36, "unique": 14, "accepted_values": 7, "relationships": 6, "expression": 1}
    failed = {(r.table, r.column, r.check): r.failures for r in built.check().collect() if r.status == "fail"}
    # R1 has two rows by design; the candidate without stock has no stock id.
    expected = {
        ("raw_screening_results", "result_id", "unique"): 1,
        ("dim_antibody_candidates", "stock_id", "not_null"): 1,
    }
    if built.profile is STRICT:
        expected |= {
            ("stg_screening_results", "result_id", "unique"): 1,
            ("stg_screening_results", "measurement_id", "unique"): 1,
            ("fct_screening_results", "measurement_id", "unique"): 1,
            ("mart_experiment_summary", "experiment_id", "unique"): 1,
        }
    assert failed == expected


def test_freshness(built):
    status = {name: df.head().status for name, df in built.check_freshness(dt.date(2026, 6, 9)).items()}
    assert status == {"experiments": "pass", "samples": "warn", "stocks": "warn", "screening_results": "warn"}
    assert {df.head().status for df in built.check_freshness(dt.date(2026, 6, 30)).values()} == {"error"}


def test_views_lineage_and_repeat(built):
    built.register_views()
    spark = built.spark
    assert spark.sql("select count(*) from mart_antibody_candidate_summary").head()[0] == 2
    lineage = batch_lineage(built.raw("experiments"), "experiments").collect()
    assert [r.n_files for r in lineage] == [1, 1] and {r.source_batch for r in lineage} != set()
    before = {n: t.drop("dbt_updated_at").collect() for n, t in built.layers().items()}
    built.build(RUN, AS_OF)
    after = {n: t.drop("dbt_updated_at").collect() for n, t in built.layers().items()}
    for name in before:
        assert sorted(map(str, before[name])) == sorted(map(str, after[name])), name


def test_late_version_gets_the_processing_day_and_wins(spark, tmp_path):
    pipeline = Pipeline(spark, str(tmp_path), COMPAT, buckets=2)
    ingest(pipeline, tmp_path, D1)
    pipeline.merge_model("dim_experiments", RUN)
    raw = pipeline.raw("experiments")
    late = raw.filter("id = 'E2'").withColumns({"status": F.lit("Draft"), "ingest_date": F.lit(D2)})
    pipeline.merge_model("dim_experiments", RUN, raw.unionByName(late))
    assert by(pipeline.table("dim_experiments").read(), "experiment_id")["E2"].experiment_status == "Draft"


def test_empty_target_fills_only_in_strict(spark, tmp_path):
    for profile, expected in ((COMPAT, 0), (STRICT, 4)):
        root = tmp_path / profile.name
        pipeline = Pipeline(spark, str(root), profile, buckets=2)
        ingest(pipeline, root, D1)
        pipeline.merge_model("dim_samples", RUN, pipeline.raw("samples").filter("false"))
        pipeline.merge_model("dim_samples", RUN)
        assert pipeline.table("dim_samples").read().count() == expected


def gated(spark, tmp_path, mark=None):
    pipeline = Pipeline(spark, str(tmp_path), STRICT, buckets=2)
    ingest(pipeline, tmp_path, D1)
    return pipeline


def test_a_failed_check_keeps_the_old_version_and_skips_what_depends_on_it(spark, tmp_path):
    pipeline = gated(spark, tmp_path)
    # The candidate without stock breaks a declared check of the wide dimension.
    outcome = pipeline.build(RUN, AS_OF, gate=True)
    assert outcome["dim_antibody_candidates"] == "failed: dim_antibody_candidates: stock_id not_null (1)"
    assert outcome["mart_antibody_candidate_summary"] == "skipped: dim_antibody_candidates"
    assert {t for t, o in outcome.items() if o == "built"} == {*pipeline.merged_models, "mart_experiment_summary"}
    assert not pipeline.table("dim_antibody_candidates").exists()

    before = sorted(map(str, pipeline.table("dim_experiments").read().collect()))
    raw = pipeline.raw("experiments")
    bad = raw.filter("id = 'E2'").withColumns({"status": F.lit("Lost"), "ingest_date": F.lit(D2)})
    with pytest.raises(ChecksFailed, match="experiment_status accepted_values"):
        pipeline.merge_model("dim_experiments", RUN, raw.unionByName(bad), gate=True)
    assert sorted(map(str, pipeline.table("dim_experiments").read().collect())) == before


def test_checks_of_rows_are_counted_while_they_are_written(spark, tmp_path):
    pipeline = gated(spark, tmp_path)
    pipeline.build(RUN, AS_OF)
    table = pipeline.table("mart_experiment_summary")
    rows = table.read()
    before, nobody = rows.count(), rows.withColumn("experiment_id", F.lit(None).cast("string"))
    with pytest.raises(ChecksFailed) as failed:
        pipeline._store("mart_experiment_summary", nobody, gate=True, merge=False)
    assert failed.value.failures == {"experiment_id not_null": before}
    assert table.read().filter("experiment_id is null").count() == 0
    # A stock of an unknown sample: a check against another table, made on what was written.
    lost = pipeline.raw("stocks").limit(1).withColumns({"id": F.lit("KX"), "sample_id": F.lit("?"), "ingest_date": F.lit(D2)})
    with pytest.raises(ChecksFailed, match="sample_id relationships .1."):
        pipeline.merge_model("dim_stocks", RUN, pipeline.raw("stocks").unionByName(lost), gate=True)
    assert pipeline.table("dim_stocks").read().filter("stock_id = 'KX'").count() == 0


def test_later_runs_do_not_scan_the_target(spark, tmp_path):
    pipeline = gated(spark, tmp_path)
    pipeline.build(RUN, AS_OF)
    ingest(pipeline, tmp_path, D2)
    plan = pipeline._slice("dim_experiments")._jdf.queryExecution().executedPlan().toString()
    assert "tables/" not in plan and f"{D1}" in plan
    pipeline.merge_model("dim_experiments", RUN)
    assert pipeline.table("dim_experiments").newest_day() == D2


def test_checks_are_evaluated_a_table_at_a_time(built):
    found = built.check()
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    at_once = run_checks(built.layers(), declared_checks())
    assert found.schema.names == at_once.schema.names
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, at_once.collect()))


def test_a_build_in_passes_gives_the_same_tables(spark, tmp_path, built, monkeypatch):
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    pipeline = Pipeline(spark, str(tmp_path), built.profile, buckets=2)
    for day in (D1, D2):
        ingest(pipeline, tmp_path, day)
        assert set(pipeline.build(RUN, AS_OF).values()) == {"built"}
    assert len(passes.in_passes(pipeline.raw("screening_results"), "result_id")) == passes.MAX_PASSES
    for name in (*pipeline.merged_models, "mart_experiment_summary"):
        want, got = built.table(name).read(), pipeline.table(name).read()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_a_gated_merge_in_passes_counts_all_failures(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(passes, "PASS_BYTES", 1)
    pipeline = gated(spark, tmp_path)
    pipeline.merge_model("dim_experiments", RUN)
    nobody = {"stock_id": F.lit(None).cast("string"), "sample_id": F.lit("?")}
    rows = pipeline.table("dim_experiments").read().withColumns(nobody).select(*nobody, "ingest_date")
    with pytest.raises(ChecksFailed) as failed:
        pipeline._store("dim_stocks", [rows.limit(1), rows.limit(2)], gate=True, merge=True)
    assert failed.value.failures == {"stock_id not_null": 3}
