"""Laboratory raw tables read off the star-schema tables.

An order stands for an experiment and for a result, each line of it for a landed version of
the record; a part stands for a sample, whose type follows the part type; a part
and line number stand for a stock. All lines are used. Text columns are text, as
landed. Lines of one year count as loaded on one day. Every frame has the same
rows as the SQL of the same name in ``RAW``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.queries.base import table

AS_OF = date(2000, 1, 1)

SAMPLE_TYPES = {
    "PROMO": "antibody_candidate",
    "STANDARD": "pbmc",
    "MEDIUM": "cell_line",
    "LARGE": "plasma_fraction",
    "ECONOMY": "protein_extract",
    "SMALL": "tumor_sample",
}

ENDPOINTS = {
    1: "Binding Affinity",
    2: "Cytotoxicity",
    3: "IL-2",
    4: "IFN-gamma",
    5: "Reporter Inhibition",
    6: "Cytotoxicity",
    7: "Binding Affinity",
}


def _pick(key: Column, choices: dict) -> Column:
    chosen = None
    for value, result in choices.items():
        chosen = F.when(key == value, result) if chosen is None else chosen.when(key == value, result)
    return chosen


def _text(ts: Column) -> Column:
    return ts.cast("string")


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def _id(prefix: str, *parts: str) -> Column:
    return F.concat(F.lit(prefix), F.concat_ws("-", *(F.col(p).cast("string") for p in parts)))


def _shipped() -> Column:
    return F.col("l_shipdate")


def _load_day() -> Column:
    return F.trunc(_shipped().cast("date"), "YEAR")


def _is_f() -> Column:
    return F.col("l_linestatus") == "F"


def _is_n() -> Column:
    return F.col("l_returnflag") == "N"


def _quantity() -> Column:
    return F.col("l_quantity")


def _line() -> Column:
    return F.col("l_linenumber")


def _updated_at() -> Column:
    return F.when(_is_n(), "").otherwise(_text(_shipped() + _hours(_quantity())))


def raw_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = _shipped() + _hours(_quantity() * 7)
    witnessed = signed + _hours(_quantity() * 5)
    is_witnessed = _is_f() & ~_is_n()
    return table(spark, sf_dir, "lineitem").select(
        _id("EXP-", "l_orderkey").alias("id"),
        F.concat(F.lit("\t Order "), F.col("l_orderkey").cast("string"), F.lit("  ")).alias("name"),
        F.concat(F.lit("PRJ00"), (F.col("l_suppkey") % 3 + 1).cast("string")).alias("project"),
        _pick(F.col("l_returnflag"), {"R": "Witnessed", "A": "Signed", "N": "Draft"}).alias("status"),
        _shipped().cast("date").cast("string").alias("run_date"),
        _id("Author ", "l_suppkey").alias("author"),
        F.when(is_witnessed, _id("Witness ", "l_partkey")).alias("witnessed_by"),
        _id("Protocol ", "l_linenumber").alias("protocol_name"),
        F.concat(F.lit("ICI-"), (_line() + 1000).cast("string")).alias("protocol_code"),
        _id("v", "l_linenumber").alias("protocol_version"),
        _text(_shipped()).alias("created_at"),
        F.when(_is_f(), _text(signed)).when(~_is_n(), "").alias("signed_at"),
        F.when(is_witnessed, _text(witnessed)).otherwise("").alias("witnessed_at"),
        _load_day().alias("ingest_date"),
    )


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    kind = F.col("p_type")

    def only(part_type: str, value: Column) -> Column:
        return F.when(kind == part_type, value)

    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        _id("SMP-", "p_partkey").alias("id"),
        F.concat(F.lit("\t"), F.col("p_name"), F.lit(" \n")).alias("sample_name"),
        F.col("p_brand").alias("internal_code"),
        _pick(kind, SAMPLE_TYPES).alias("sample_type"),
        _id("Supplier ", "l_suppkey").alias("created_by"),
        _text(_shipped() - F.make_dt_interval(F.lit(30))).alias("created_at"),
        _updated_at().alias("updated_at"),
        only("MEDIUM", F.col("p_name")).alias("cell_line_name"),
        only("MEDIUM", F.col("p_brand")).alias("cell_line_tissue_origin"),
        only("MEDIUM", _line()).alias("cell_line_passage_number"),
        only("LARGE", F.col("p_brand")).alias("plasma_fraction_type"),
        only("LARGE", F.col("p_size")).alias("plasma_donor_pool_size"),
        only("LARGE", F.col("l_returnflag")).alias("plasma_pathogen_screening_status"),
        only("LARGE", _line() * -10).alias("plasma_storage_temperature_c"),
        only("ECONOMY", F.col("p_name")).alias("protein_source_material"),
        only("ECONOMY", F.col("l_linestatus")).alias("protein_lysis_buffer"),
        only("ECONOMY", _quantity()).alias("protein_yield_mg"),
        only("ECONOMY", _quantity() * 2).alias("protein_purity_percent"),
        only("SMALL", F.col("p_name")).alias("tumor_type"),
        only("SMALL", F.col("l_returnflag")).alias("tumor_stage"),
        only("SMALL", F.col("p_brand")).alias("tumor_collection_site"),
        only("SMALL", _quantity()).alias("tumor_necrosis_percent"),
        only("STANDARD", _id("DON-", "l_suppkey")).alias("pbmc_donor_id"),
        only("STANDARD", _quantity() * 2).alias("pbmc_viability_percent"),
        only("STANDARD", F.col("l_linestatus")).alias("pbmc_isolation_method"),
        only("STANDARD", F.col("l_returnflag") == "R").alias("pbmc_cryopreserved"),
        only("PROMO", F.col("p_brand")).alias("antibody_format"),
        only("PROMO", F.col("p_name")).alias("antibody_target_antigen"),
        only("PROMO", _id("CLN-", "p_partkey")).alias("antibody_clone_id"),
        only("PROMO", _quantity()).alias("antibody_binding_affinity_nm"),
        only("PROMO", F.col("p_size") > 25).alias("antibody_humanized"),
        _load_day().alias("ingest_date"),
    )


def raw_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    no_expiry = _is_n() & ~_is_f()
    return table(spark, sf_dir, "lineitem").select(
        _id("STK-", "l_partkey", "l_linenumber").alias("id"),
        _id("SMP-", "l_partkey").alias("sample_id"),
        _id("Supplier ", "l_suppkey").alias("stock_owner"),
        _id("LOT-", "l_orderkey").alias("lot_number"),
        (_quantity() - 10).alias("quantity"),
        F.lit("mg").alias("quantity_unit"),
        F.col("l_discount").alias("concentration"),
        F.lit("mg/mL").alias("concentration_unit"),
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("storage_location"),
        _text(_shipped()).alias("created_at"),
        F.when(_is_n(), "").otherwise(_text(_shipped() + _hours(F.lit(24)))).alias("stored_at"),
        F.when(no_expiry, "")
        .otherwise(F.date_add(_shipped().cast("date"), _quantity().cast("int")).cast("string"))
        .alias("expiry_date"),
        _updated_at().alias("updated_at"),
        _load_day().alias("ingest_date"),
    )


def raw_screening_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = (F.col("l_returnflag") == "R") & ~_is_f()
    endpoint = _pick(_line(), ENDPOINTS)
    return table(spark, sf_dir, "lineitem").select(
        _id("RES-", "l_orderkey").alias("result_id"),
        _id("MEA-", "l_orderkey", "l_linenumber").alias("measurement_id"),
        _id("EXP-", "l_orderkey").alias("experiment_id"),
        _id("STK-", "l_partkey", "l_linenumber").alias("stock_id"),
        _id("SMP-", "l_partkey").alias("sample_id"),
        F.concat(F.lit("ICI-"), (_line() + 1002).cast("string")).alias("protocol_code"),
        _id("Protocol ", "l_linenumber").alias("protocol_name"),
        F.lit("v1").alias("protocol_version"),
        _id("CLN-", "l_partkey").alias("antibody_clone_id"),
        F.col("l_returnflag").alias("antibody_target_antigen"),
        F.col("l_linestatus").alias("antibody_format"),
        (_line() > 3).alias("antibody_humanized"),
        F.lit("Screening").alias("assay_category"),
        _id("Assay ", "l_linenumber").alias("assay_name"),
        endpoint.alias("endpoint_name"),
        F.lit("nM").alias("endpoint_unit"),
        F.when(endpoint == "Cytotoxicity", _quantity() + 40).otherwise(_quantity()).alias("endpoint_value"),
        _line().cast("double").alias("treatment_concentration"),
        F.lit("nM").alias("treatment_concentration_unit"),
        _pick(F.col("l_returnflag"), {"A": "Vehicle", "R": "Test Article"}).alias("control_type"),
        _line().alias("replicate_number"),
        F.lit(3).alias("replicates_expected"),
        (_line() * 24).alias("measurement_timepoint_hours"),
        _id("Instrument ", "l_suppkey").alias("instrument_name"),
        F.when(failed, "Fail").otherwise("Pass").alias("qc_flag"),
        _load_day().alias("ingest_date"),
    )


RAW_TABLES = {
    "experiments": raw_experiments,
    "samples": raw_samples,
    "stocks": raw_stocks,
    "screening_results": raw_screening_results,
}


# -- the same tables, and the models over them, in SQL -------------------------------


def _case(key: str, choices: dict) -> str:
    whens = " ".join(f"when {k!r} then {v!r}" for k, v in choices.items())
    return f"case {key} {whens} end"


_UPDATED = """case when l_returnflag = 'N' then ''
    else cast(l_shipdate + to_hours(cast(l_quantity as bigint)) as varchar) end"""
_SIGNED = "(l_shipdate + to_hours(cast(l_quantity * 7 as bigint)))"
_WITNESSED = f"({_SIGNED} + to_hours(cast(l_quantity * 5 as bigint)))"
_IS_WITNESSED = "(l_linestatus = 'F' and l_returnflag <> 'N')"
_LOAD_DAY = "cast(date_trunc('year', l_shipdate) as date)"

RAW = {
    "raw_experiments": f"""
select 'EXP-' || l_orderkey as id, chr(9) || ' Order ' || l_orderkey || '  ' as name,
    'PRJ00' || (l_suppkey % 3 + 1) as project,
    {_case("l_returnflag", {"R": "Witnessed", "A": "Signed", "N": "Draft"})} as status,
    cast(cast(l_shipdate as date) as varchar) as run_date, 'Author ' || l_suppkey as author,
    case when {_IS_WITNESSED} then 'Witness ' || l_partkey end as witnessed_by,
    'Protocol ' || l_linenumber as protocol_name, 'ICI-' || (l_linenumber + 1000) as protocol_code,
    'v' || l_linenumber as protocol_version, cast(l_shipdate as varchar) as created_at,
    case when l_linestatus = 'F' then cast({_SIGNED} as varchar)
        when l_returnflag <> 'N' then '' end as signed_at,
    case when {_IS_WITNESSED} then cast({_WITNESSED} as varchar) else '' end as witnessed_at,
    {_LOAD_DAY} as ingest_date
from lineitem""",
    "raw_samples": f"""
select 'SMP-' || p_partkey as id, chr(9) || p_name || ' ' || chr(10) as sample_name,
    p_brand as internal_code, {_case("p_type", SAMPLE_TYPES)} as sample_type,
    'Supplier ' || l_suppkey as created_by,
    cast(l_shipdate - interval 30 day as varchar) as created_at, {_UPDATED} as updated_at,
    case when p_type = 'MEDIUM' then p_name end as cell_line_name,
    case when p_type = 'MEDIUM' then p_brand end as cell_line_tissue_origin,
    case when p_type = 'MEDIUM' then l_linenumber end as cell_line_passage_number,
    case when p_type = 'LARGE' then p_brand end as plasma_fraction_type,
    case when p_type = 'LARGE' then p_size end as plasma_donor_pool_size,
    case when p_type = 'LARGE' then l_returnflag end as plasma_pathogen_screening_status,
    case when p_type = 'LARGE' then l_linenumber * -10 end as plasma_storage_temperature_c,
    case when p_type = 'ECONOMY' then p_name end as protein_source_material,
    case when p_type = 'ECONOMY' then l_linestatus end as protein_lysis_buffer,
    case when p_type = 'ECONOMY' then l_quantity end as protein_yield_mg,
    case when p_type = 'ECONOMY' then l_quantity * 2 end as protein_purity_percent,
    case when p_type = 'SMALL' then p_name end as tumor_type,
    case when p_type = 'SMALL' then l_returnflag end as tumor_stage,
    case when p_type = 'SMALL' then p_brand end as tumor_collection_site,
    case when p_type = 'SMALL' then l_quantity end as tumor_necrosis_percent,
    case when p_type = 'STANDARD' then 'DON-' || l_suppkey end as pbmc_donor_id,
    case when p_type = 'STANDARD' then l_quantity * 2 end as pbmc_viability_percent,
    case when p_type = 'STANDARD' then l_linestatus end as pbmc_isolation_method,
    case when p_type = 'STANDARD' then l_returnflag = 'R' end as pbmc_cryopreserved,
    case when p_type = 'PROMO' then p_brand end as antibody_format,
    case when p_type = 'PROMO' then p_name end as antibody_target_antigen,
    case when p_type = 'PROMO' then 'CLN-' || p_partkey end as antibody_clone_id,
    case when p_type = 'PROMO' then l_quantity end as antibody_binding_affinity_nm,
    case when p_type = 'PROMO' then p_size > 25 end as antibody_humanized,
    {_LOAD_DAY} as ingest_date
from lineitem join part on l_partkey = p_partkey""",
    "raw_stocks": f"""
select 'STK-' || l_partkey || '-' || l_linenumber as id, 'SMP-' || l_partkey as sample_id,
    'Supplier ' || l_suppkey as stock_owner, 'LOT-' || l_orderkey as lot_number,
    l_quantity - 10 as quantity, 'mg' as quantity_unit, l_discount as concentration,
    'mg/mL' as concentration_unit, l_returnflag || '-' || l_linestatus as storage_location,
    cast(l_shipdate as varchar) as created_at,
    case when l_returnflag = 'N' then '' else cast(l_shipdate + interval 1 day as varchar) end as stored_at,
    case when l_returnflag = 'N' and l_linestatus <> 'F' then ''
        else cast(cast(l_shipdate as date) + cast(l_quantity as int) as varchar) end as expiry_date,
    {_UPDATED} as updated_at, {_LOAD_DAY} as ingest_date
from lineitem""",
    "raw_screening_results": f"""
select 'RES-' || l_orderkey as result_id, 'MEA-' || l_orderkey || '-' || l_linenumber as measurement_id,
    'EXP-' || l_orderkey as experiment_id, 'STK-' || l_partkey || '-' || l_linenumber as stock_id,
    'SMP-' || l_partkey as sample_id, 'ICI-' || (l_linenumber + 1002) as protocol_code,
    'Protocol ' || l_linenumber as protocol_name, 'v1' as protocol_version,
    'CLN-' || l_partkey as antibody_clone_id, l_returnflag as antibody_target_antigen,
    l_linestatus as antibody_format, l_linenumber > 3 as antibody_humanized,
    'Screening' as assay_category, 'Assay ' || l_linenumber as assay_name,
    {_case("l_linenumber", ENDPOINTS)} as endpoint_name, 'nM' as endpoint_unit,
    case when l_linenumber in (2, 6) then l_quantity + 40 else l_quantity end as endpoint_value,
    cast(l_linenumber as double) as treatment_concentration, 'nM' as treatment_concentration_unit,
    {_case("l_returnflag", {"A": "Vehicle", "R": "Test Article"})} as control_type,
    l_linenumber as replicate_number, 3 as replicates_expected,
    l_linenumber * 24 as measurement_timepoint_hours, 'Instrument ' || l_suppkey as instrument_name,
    case when l_returnflag = 'R' and l_linestatus <> 'F' then 'Fail' else 'Pass' end as qc_flag,
    {_LOAD_DAY} as ingest_date
from lineitem""",
}

_TRIMMED = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g') as {1}"
_TS = "cast(nullif({0}, '') as timestamp) as {0}"
_UPDATED_TS = "cast(nullif(updated_at, '') as timestamp)"


def newest(raw: str, keys: str, order: str, tie_break: str) -> str:
    ties = ", ".join(f"{c.strip()} asc nulls last" for c in tie_break.split(","))
    return f"""
select * from {raw}
qualify row_number() over (partition by {keys} order by {order}, {ties}) = 1"""


_EXPERIMENT_TIES = (
    "name, project, status, run_date, author, protocol_name, protocol_code, protocol_version, created_at, "
    "signed_at, witnessed_by, witnessed_at"
)
_SAMPLE_TIES = (
    "sample_name, internal_code, sample_type, created_by, created_at, updated_at, cell_line_name, "
    "cell_line_tissue_origin, cell_line_passage_number, plasma_fraction_type, plasma_donor_pool_size, "
    "plasma_pathogen_screening_status, plasma_storage_temperature_c, protein_source_material, "
    "protein_lysis_buffer, protein_yield_mg, protein_purity_percent, tumor_type, tumor_stage, "
    "tumor_collection_site, tumor_necrosis_percent, pbmc_donor_id, pbmc_viability_percent, "
    "pbmc_isolation_method, pbmc_cryopreserved, antibody_format, antibody_target_antigen, "
    "antibody_clone_id, antibody_binding_affinity_nm, antibody_humanized"
)
_STOCK_TIES = (
    "sample_id, stock_owner, lot_number, quantity, quantity_unit, concentration, concentration_unit, "
    "storage_location, created_at, stored_at, expiry_date, updated_at"
)
_RESULT_TIES = (
    "measurement_id, replicate_number, stock_id, sample_id, experiment_id, protocol_code, protocol_name, "
    "protocol_version, antibody_clone_id, antibody_target_antigen, antibody_format, antibody_humanized, "
    "assay_category, assay_name, endpoint_name, endpoint_unit, endpoint_value, treatment_concentration, "
    "treatment_concentration_unit, control_type, replicates_expected, measurement_timepoint_hours, "
    "instrument_name, qc_flag"
)
_BY_DAY = "ingest_date desc nulls last"
_BY_UPDATE = f"{_BY_DAY}, {_UPDATED_TS} desc nulls last"

_TYPED_RESULTS = """
select result_id, measurement_id, experiment_id, sample_id, stock_id, protocol_code, protocol_name,
    protocol_version, antibody_clone_id, antibody_target_antigen, antibody_format, antibody_humanized,
    assay_category, assay_name, endpoint_name, endpoint_unit, endpoint_value, treatment_concentration,
    treatment_concentration_unit, control_type, replicate_number, replicates_expected,
    cast(measurement_timepoint_hours as double) as measurement_timepoint_hours, instrument_name,
    qc_flag, ingest_date
from ({0})"""

_FACT = """
select result_id, measurement_id, experiment_id, sample_id, stock_id, protocol_code, protocol_name,
    protocol_version, antibody_clone_id, antibody_target_antigen, antibody_format, antibody_humanized,
    assay_name, assay_category, endpoint_name, endpoint_unit, endpoint_value, treatment_concentration,
    treatment_concentration_unit, measurement_timepoint_hours, control_type, replicate_number,
    replicates_expected, qc_flag, case when qc_flag = 'Pass' then true else false end as is_qc_pass,
    case when control_type <> 'Test Article' then true else false end as is_control,
    instrument_name, ingest_date
from {0}"""

# The marts from their specification: each side is counted by itself, labels come from finished columns.
_ATTRIBUTES = "sample_id, sample_name, internal_code, antibody_clone_id, antibody_target_antigen, antibody_format, antibody_humanized"
_CANDIDATE_MART = f"""
with held as (
    select {{{{{", ".join(f"'{c}': {c}" for c in _ATTRIBUTES.split(", "))}}}}} as candidate, sample_id, stock_id,
        not is_expired and not is_depleted as usable, ingest_date
    from dim_antibody_candidates
), sides as (
    select candidate, count(distinct stock_id) as num_available_stocks, count(distinct stock_id) filter (usable) as num_usable_stocks,
        max(ingest_date) as latest_candidate_ingest_date
    from held group by candidate
), tests as (
    select candidate as tested, count(distinct experiment_id) as experiments, count(distinct stock_id) as stocks, count(result_id) as outcomes,
        avg(endpoint_value) filter (endpoint_name = 'Binding Affinity') as avg_binding_affinity_nm,
        avg(endpoint_value) filter (endpoint_name = 'Cytotoxicity') as avg_cytotoxicity_percent,
        avg(endpoint_value) filter (endpoint_name in ('IFN-gamma', 'IL-2')) as avg_cytokine_release_pg_ml,
        avg(endpoint_value) filter (endpoint_name in ('CD69 Positive T Cells', 'Reporter Inhibition')) as avg_activation_or_inhibition_percent,
        cast(count(*) filter (is_qc_pass) as double) / nullif(count(result_id), 0) as qc_pass_rate,
        max(r.ingest_date) as latest_screening_ingest_date
    from held join {{0}} r using (sample_id, stock_id) group by candidate
), finished as (
    select candidate.*, * exclude (candidate, tested, experiments, stocks, outcomes), coalesce(experiments, 0) as num_experiments,
        coalesce(stocks, 0) as num_stocks_tested, coalesce(outcomes, 0) as num_screening_results, coalesce(qc_pass_rate, 0) as rate
    from sides left join tests on candidate is not distinct from tested
)
select * exclude (rate), case
    when avg_binding_affinity_nm <= 50 and coalesce(avg_cytotoxicity_percent, 0) >= 50 and rate >= 0.9 then 'Advance'
    when rate < 0.8 then 'Review QC'
    else 'Hold' end as candidate_recommendation
from finished"""

_EXPERIMENT_MART = """
with states as (
    select *, case
        when is_signed and is_witnessed then 'Complete'
        when is_signed and not is_witnessed then 'Signed Not Witnessed'
        when not is_signed then 'Unsigned'
        else 'Other' end as compliance_status
    from {1}
), outcomes as (
    select result_id, experiment_id as tested_experiment, sample_id, stock_id, assay_name, endpoint_name, instrument_name, is_qc_pass,
        ingest_date as screening_result_ingest_date, if(is_qc_pass, 'QC Pass', 'QC Fail') as outcome
    from {0} where experiment_id is not null
)
select s.* exclude (ingest_date, witnessed_by), s.ingest_date as experiment_ingest_date, cast(date_trunc('month', run_date) as date) as run_month,
    compliance_status = 'Complete' and greatest(days_created_to_signed, 0) <= 7 and greatest(days_signed_to_witnessed, 0) <= 7
        as is_compliance_complete_within_7_days,
    outcome is not null as has_screening_result, o.* exclude (tested_experiment, outcome), coalesce(outcome, 'No Result') as qc_status
from states s left join outcomes o on tested_experiment = experiment_id"""

MODELS = {
    **RAW,
    "stg_experiments": f"""
select id as experiment_id, {_TRIMMED.format("name", "experiment_name")}, project,
    status as experiment_status, cast(run_date as date) as run_date, author as experiment_author,
    protocol_name, protocol_code, protocol_version, cast(created_at as timestamp) as created_at,
    {_TS.format("signed_at")}, witnessed_by, {_TS.format("witnessed_at")}, ingest_date
from ({newest("raw_experiments", "id", _BY_DAY, _EXPERIMENT_TIES)})""",
    "stg_samples": f"""
select * exclude (id, sample_name, created_at, updated_at), id as sample_id,
    {_TRIMMED.format("sample_name", "sample_name")}, cast(created_at as timestamp) as created_at,
    {_TS.format("updated_at")}
from ({newest("raw_samples", "id", _BY_UPDATE, _SAMPLE_TIES)})""",
    "stg_stocks": f"""
select id as stock_id, sample_id, stock_owner, lot_number, quantity, quantity_unit, concentration,
    concentration_unit, storage_location, cast(created_at as timestamp) as created_at,
    {_TS.format("stored_at")}, cast(nullif(expiry_date, '') as date) as expiry_date,
    {_TS.format("updated_at")}, ingest_date
from ({newest("raw_stocks", "id", _BY_UPDATE, _STOCK_TIES)})""",
    "stg_screening_results": _TYPED_RESULTS.format(
        newest("raw_screening_results", "result_id", _BY_DAY, _RESULT_TIES)
    ),
    "stg_replicates": _TYPED_RESULTS.format(
        newest(
            "raw_screening_results", "result_id, measurement_id, stock_id, replicate_number", _BY_DAY, _RESULT_TIES
        )
    ),
    "int_experiments": """
select *, signed_at is not null as is_signed, witnessed_at is not null as is_witnessed,
    date_sub('day', created_at, signed_at) as days_created_to_signed,
    date_sub('day', signed_at, witnessed_at) as days_signed_to_witnessed
from stg_experiments""",
    "fct_screening_results": _FACT.format("stg_screening_results"),
    "fct_replicates": _FACT.format("stg_replicates"),
    "dim_antibody_candidates": f"""
with vials as (
    select stock_id, sample_id as held_sample, stock_owner, lot_number, quantity, quantity_unit, concentration, concentration_unit,
        storage_location, created_at as stock_created_at, stored_at, expiry_date, updated_at as stock_updated_at,
        date_diff('day', date '{AS_OF}', expiry_date) as days_until_expiry, ingest_date as stock_day
    from stg_stocks
), held as (
    select sample_id, sample_name, internal_code, sample_type, created_by, created_at, updated_at, antibody_clone_id, antibody_target_antigen,
        antibody_format, antibody_binding_affinity_nm, antibody_humanized, ingest_date as sample_day, v.* exclude (held_sample)
    from stg_samples left join vials v on held_sample = sample_id where sample_type = 'antibody_candidate'
)
select * exclude (sample_day, stock_day, days_until_expiry), cast(days_until_expiry as bigint) as days_until_expiry,
    if(stock_id is not null, coalesce(days_until_expiry < 0, false), null) as is_expired,
    if(stock_id is not null, coalesce(quantity <= 0, false), null) as is_depleted,
    if(stock_day >= sample_day or stock_day is null, stock_day, coalesce(sample_day, stock_day)) as ingest_date
from held""",
    "mart_antibody_candidate_summary": _CANDIDATE_MART.format("fct_screening_results"),
    "mart_candidate_replicates": _CANDIDATE_MART.format("fct_replicates"),
    "mart_experiment_summary": _EXPERIMENT_MART.format("fct_screening_results", "int_experiments"),
    "mart_experiment_replicates": _EXPERIMENT_MART.format("fct_replicates", "int_experiments"),
}


def lab_sql(body: str) -> str:
    """A statement that may refer to any raw table or model by name."""
    wanted, pending = set(), [body]
    while pending:
        text = pending.pop()
        for name in MODELS:
            if name not in wanted and name in text:
                wanted.add(name)
                pending.append(MODELS[name])
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in MODELS.items() if name in wanted)
    return f"with {ctes}\n{body}"
