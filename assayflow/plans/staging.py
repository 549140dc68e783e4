"""Raw rows to typed rows, newest version per key.

The first order column is always the ingest day, newest first. A filter for
days from some day on therefore gives the same rows before as after the
reduction, and callers apply it to the raw scan, where it prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.functions import as_timestamp, elapsed_days
from assayflow.operators.columns import project
from assayflow.operators.dedup import dedup
from assayflow.plans.profiles import COMPAT, Profile

EXPERIMENT_COLUMNS = (
    "id as_is experiment_id",
    "name trim experiment_name",
    "project",
    "status as_is experiment_status",
    "run_date date",
    "author as_is experiment_author",
    "protocol_name",
    "protocol_code",
    "protocol_version",
    "created_at timestamp",
    "signed_at timestamp",
    "witnessed_by",
    "witnessed_at timestamp",
    "ingest_date day",
)

SAMPLE_COLUMNS = (
    "id as_is sample_id",
    "sample_name trim",
    "internal_code",
    "sample_type",
    "created_by",
    "created_at timestamp",
    "updated_at timestamp",
    "cell_line_name",
    "cell_line_tissue_origin",
    "cell_line_passage_number int",
    "plasma_fraction_type",
    "plasma_donor_pool_size int",
    "plasma_pathogen_screening_status",
    "plasma_storage_temperature_c",
    "protein_source_material",
    "protein_lysis_buffer",
    "protein_yield_mg double",
    "protein_purity_percent double",
    "tumor_type",
    "tumor_stage",
    "tumor_collection_site",
    "tumor_necrosis_percent double",
    "pbmc_donor_id",
    "pbmc_viability_percent double",
    "pbmc_isolation_method",
    "pbmc_cryopreserved boolean",
    "antibody_format",
    "antibody_target_antigen",
    "antibody_clone_id",
    "antibody_binding_affinity_nm double",
    "antibody_humanized boolean",
    "ingest_date day",
)

STOCK_COLUMNS = (
    "id as_is stock_id",
    "sample_id",
    "stock_owner",
    "lot_number",
    "quantity double",
    "quantity_unit",
    "concentration double",
    "concentration_unit",
    "storage_location",
    "created_at timestamp",
    "stored_at timestamp",
    "expiry_date date",
    "updated_at timestamp",
    "ingest_date day",
)

RESULT_COLUMNS = (
    "result_id",
    "measurement_id",
    "experiment_id",
    "sample_id",
    "stock_id",
    "protocol_code",
    "protocol_name",
    "protocol_version",
    "antibody_clone_id",
    "antibody_target_antigen",
    "antibody_format",
    "antibody_humanized",
    "assay_category",
    "assay_name",
    "endpoint_name",
    "endpoint_unit",
    "endpoint_value double",
    "treatment_concentration double",
    "treatment_concentration_unit",
    "control_type",
    "replicate_number int",
    "replicates_expected int",
    "measurement_timepoint_hours double",
    "instrument_name",
    "qc_flag",
    "ingest_date day",
)


# Which of several rows of one result is kept when they came on the same day.
RESULT_TIES = ("measurement_id", "replicate_number", "stock_id", "sample_id")


def _newest_day(raw: DataFrame) -> Column:
    """The day as it is where it is a date: sorting by a cast of it would shuffle both, and in a plan that needs the
    day only to sort by, other columns than in one that returns it, so that the two could not share a shuffle."""
    day = F.col("ingest_date")
    return (day if raw.schema["ingest_date"].dataType == T.DateType() else day.cast("date")).desc_nulls_last()


def _newest_update() -> Column:
    return as_timestamp(F.col("updated_at")).desc_nulls_last()


def _needed(raw: DataFrame, specs: tuple[str, ...]) -> DataFrame:
    """Only the columns the projection reads, so that the rest is pruned below the shuffle."""
    return raw.select(*(spec.split()[0] for spec in specs))


def stage_experiments(raw: DataFrame) -> DataFrame:
    """Typed experiments, one row per experiment."""
    newest = dedup(_needed(raw, EXPERIMENT_COLUMNS), ["id"], [_newest_day(raw)])
    return project(newest, EXPERIMENT_COLUMNS)


def stage_samples(raw: DataFrame) -> DataFrame:
    """Typed samples of all six types, one row per sample."""
    newest = dedup(_needed(raw, SAMPLE_COLUMNS), ["id"], [_newest_day(raw), _newest_update()])
    return project(newest, SAMPLE_COLUMNS)


def stage_stocks(raw: DataFrame) -> DataFrame:
    """Typed stocks, one row per stock."""
    newest = dedup(_needed(raw, STOCK_COLUMNS), ["id"], [_newest_day(raw), _newest_update()])
    return project(newest, STOCK_COLUMNS)


def stage_results(raw: DataFrame, profile: Profile = COMPAT) -> DataFrame:
    """Typed screening results at the grain of the profile."""
    used = {*profile.result_key, "ingest_date"}
    names = [spec.split()[0] for spec in RESULT_COLUMNS]
    ties = [c for c in dict.fromkeys((*RESULT_TIES, *names)) if c not in used]
    newest = dedup(_needed(raw, RESULT_COLUMNS), profile.result_key, [_newest_day(raw)], ties)
    return project(newest, RESULT_COLUMNS)


def enrich_lifecycle(experiments: DataFrame) -> DataFrame:
    """Sign-off flags and the whole days between the stages."""
    created, signed, witnessed = F.col("created_at"), F.col("signed_at"), F.col("witnessed_at")
    return experiments.withColumns(
        {
            "is_signed": signed.isNotNull(),
            "is_witnessed": witnessed.isNotNull(),
            "days_created_to_signed": elapsed_days(created, signed),
            "days_signed_to_witnessed": elapsed_days(signed, witnessed),
        }
    )
