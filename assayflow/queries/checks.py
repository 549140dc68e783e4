"""Data-quality checks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.operators import quality
from assayflow.operators.catalogue import ASSAYS, assay_catalogue, measurement_grid, out_of_range, replicate_status, with_assay
from assayflow.operators.joins import orphans
from assayflow.operators.quality import Check, run_checks
from assayflow.plans.checks import declared_checks
from assayflow.plans.facts import fact_results
from assayflow.plans.profiles import COMPAT
from assayflow.plans.staging import stage_experiments, stage_results, stage_samples, stage_stocks
from assayflow.queries.base import query, table
from assayflow.queries.incremental import build_lab
from assayflow.queries.lab import lab_sql, raw_experiments, raw_samples, raw_screening_results, raw_stocks

AS_OF = date(2024, 2, 8)


def _count_sql(check: Check) -> str:
    """Failures of one check."""
    t, c = check.table, check.column
    if check.kind == "not_null":
        return f"select count(*) from {t} where {c} is null"
    if check.kind == "expression":
        return f"select count(*) from {t} where not ({check.expression})"
    if check.kind == "unique":
        return f"select count(*) from (select {c} from {t} where {c} is not null group by 1 having count(*) > 1)"
    if check.kind == "accepted_values":
        return f"select count(distinct {c}) from {t} where {c} not in {check.values}"
    return (
        f"select count(*) from {t} where {c} is not null and {c} not in "
        f"(select {check.parent_column} from {check.parent} where {check.parent_column} is not null)"
    )


def checks_sql(checks: list[Check]) -> str:
    counted = "\nunion all ".join(
        f"select '{k.table}' as \"table\", '{k.column}' as \"column\", '{k.kind}' as \"check\", "
        f"({_count_sql(k)}) as failures"
        for k in checks
    )
    return f"select *, case when failures = 0 then 'pass' else 'fail' end as status from ({counted})"


NOT_NULL = [
    Check("stg_experiments", "experiment_id", "not_null"),
    Check("stg_experiments", "signed_at", "not_null"),
    Check("stg_experiments", "witnessed_at", "not_null"),
    Check("stg_stocks", "expiry_date", "not_null"),
    Check("stg_stocks", "stored_at", "not_null"),
]


@query(lab_sql(checks_sql(NOT_NULL)))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "stg_experiments": stage_experiments(raw_experiments(spark, sf_dir)),
        "stg_stocks": stage_stocks(raw_stocks(spark, sf_dir)),
    }
    return run_checks(tables, NOT_NULL)


@query("""
select l_orderkey, l_linenumber, count(*) as n_rows from lineitem group by all having count(*) > 1""")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_values(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("""
select event_type, count(*) as n_rows from events
where event_type not in ('view', 'click', 'purchase') group by event_type""")
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unaccepted_values(table(spark, sf_dir, "events"), "event_type", ("view", "click", "purchase"))


@query("""
select doc_id, count(*) as n_rows from documents where doc_id not in (select doc_id from labels) group by doc_id""")
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans(table(spark, sf_dir, "documents"), ["doc_id"], table(spark, sf_dir, "labels"), ["doc_id"])


EXPRESSIONS = [
    Check("lines", "l_quantity", "expression", expression="l_quantity <= 25"),
    Check("lines", "l_discount", "expression", expression="l_discount >= l_tax"),
    Check("lines", "l_shipdate", "expression", expression="l_shipdate <= null"),
]


@query(checks_sql(EXPRESSIONS).replace("from lines", "from lineitem"))
def dq_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_checks({"lines": table(spark, sf_dir, "lineitem")}, EXPRESSIONS)


@query(f"""
select newest, date '{AS_OF}' - newest as age_days, case when date '{AS_OF}' - newest <= 7 then 'pass'
    when date '{AS_OF}' - newest <= 14 then 'warn' else 'error' end as status
from (select cast(max(ts) as date) as newest from events)""")
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ingest_date", F.col("ts").cast("date"))
    return quality.freshness(events, AS_OF)


@query("""
select count(*) as record_count, case when count(*) > 0 then 'pass' else 'fail' end as status
from events where cast(ts as date) = date '2024-01-15'""")
def partition_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("ingest_date", F.col("ts").cast("date"))
    return quality.partition_row_count(events, date(2024, 1, 15))


_CODES = ", ".join(f"'{a[0]}'" for a in ASSAYS)


@query(lab_sql(f"""
select 'protocol_not_in_catalogue' as rule, count(*) as failures from fct_screening_results
where coalesce(protocol_code not in ({_CODES}), true)
union all select 'sample_not_antibody_candidate', count(*) from fct_screening_results r
where not exists (select 1 from stg_samples s where s.sample_type = 'antibody_candidate' and s.sample_id = r.sample_id)
union all select 'stock_not_of_sample', count(*) from fct_screening_results r
where not exists (select 1 from stg_stocks t where t.stock_id = r.stock_id and t.sample_id = r.sample_id)"""))
def dq_screening_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = fact_results(stage_results(raw_screening_results(spark, sf_dir)))
    samples, stocks = stage_samples(raw_samples(spark, sf_dir)), stage_stocks(raw_stocks(spark, sf_dir))
    return quality.screening_input_failures(results, samples, stocks, assay_catalogue(spark))


@query(lab_sql("""
select experiment_status, signed_at is not null as signed, witnessed_at is not null as witnessed, count(*) as n_rows
from stg_experiments where not case when witnessed_at is not null then experiment_status = 'Witnessed'
    when signed_at is not null then experiment_status = 'Signed'
    else experiment_status in ('Draft', 'In Review') end
group by all"""))
def dq_status_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = quality.status_mismatches(stage_experiments(raw_experiments(spark, sf_dir)))
    stages = [F.col(f"{s}_at").isNotNull().alias(s) for s in ("signed", "witnessed")]
    return wrong.groupBy("experiment_status", *stages).agg(F.count(F.lit(1)).alias("n_rows"))


def _catalogue_sql() -> str:
    rows = ", ".join(
        f"('{a[0]}', {a[5]}::double, {a[6]}::double, {list(a[3])}, {[float(c) for c in a[7]]}::double[], {a[8]}, {a[9]})"
        for a in ASSAYS
    )
    names = "protocol_code, min_value, max_value, endpoint_names, concentrations, timepoints, replicates_expected"
    return f"(values {rows}) as catalogue({names})"


@query(lab_sql(f"""
select measurement_id, protocol_code, endpoint_value, min_value, max_value
from fct_screening_results join {_catalogue_sql()} using (protocol_code)
where endpoint_value not between min_value and max_value"""))
def catalogue_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = out_of_range(fact_results(stage_results(raw_screening_results(spark, sf_dir))))
    return wrong.select("measurement_id", "protocol_code", "endpoint_value", "min_value", "max_value")


def _ordinal_protocol(column: str):
    """Protocol codes of the catalogue by the leading digit of a text, 1 to 5."""
    position = F.substring(column, 1, 1).cast("int")
    return F.element_at(F.array(*(F.lit(a[0]) for a in ASSAYS)), position)


@query(f"""
select o_orderkey, protocol_code, replicates_expected, coalesce(n, 0) as n_observed,
    case when coalesce(n, 0) < replicates_expected then 'Incomplete'
        when coalesce(n, 0) > replicates_expected then 'Excess' else 'Complete' end as replicate_status
from (select o_orderkey, ([{_CODES}])[cast(o_orderpriority[1] as int)] as protocol_code from orders)
join {_catalogue_sql()} using (protocol_code)
left join (select l_orderkey as o_orderkey, count(*) as n from lineitem group by 1) using (o_orderkey)""")
def replicate_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", _ordinal_protocol("o_orderpriority").alias("protocol_code"))
    expected = with_assay(orders, "replicates_expected", how="inner")
    observed = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return replicate_status(expected, observed, ["o_orderkey"])


@query(f"""
select p_partkey, protocol_code, endpoint_name, treatment_concentration, measurement_timepoint_hours,
    cast(unnest(range(1, replicates_expected + 1)) as int) as replicate_number
from (
    select p_partkey, protocol_code, endpoint_name, treatment_concentration, replicates_expected,
        unnest(timepoints) as measurement_timepoint_hours
    from (
        select p_partkey, protocol_code, endpoint_name, timepoints, replicates_expected,
            unnest(concentrations) as treatment_concentration
        from (
            select p_partkey, protocol_code, concentrations, timepoints, replicates_expected,
                unnest(endpoint_names) as endpoint_name
            from (select p_partkey, ([{_CODES}])[p_size % 6] as protocol_code from part)
            join {_catalogue_sql()} using (protocol_code)
        )
    )
)""")
def design_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(*(F.lit(a[0]) for a in ASSAYS))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.get(codes, F.col("p_size") % 6 - 1).alias("protocol_code")
    )
    return measurement_grid(parts)


_SUITE_TABLES = {
    "dim_experiments": "int_experiments",
    "dim_samples": "stg_samples",
    "dim_stocks": "stg_stocks",
}


def _suite_sql() -> str:
    sql = checks_sql(declared_checks())
    for stored, view in _SUITE_TABLES.items():
        sql = sql.replace(f"from {stored} ", f"from {view} ")
    return lab_sql(sql)


@query(_suite_sql())
def dq_declared_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks over raw, staged and stored tables."""
    return build_lab(spark, sf_dir, COMPAT).check()
