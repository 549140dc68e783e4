"""The fact table of screening results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayflow.functions import flag

FACT_COLUMNS = (
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
    "assay_name",
    "assay_category",
    "endpoint_name",
    "endpoint_unit",
    "endpoint_value",
    "treatment_concentration",
    "treatment_concentration_unit",
    "measurement_timepoint_hours",
    "control_type",
    "replicate_number",
    "replicates_expected",
    "qc_flag",
    "is_qc_pass",
    "is_control",
    "instrument_name",
    "ingest_date",
)


def fact_results(staged: DataFrame) -> DataFrame:
    """Results with quality and control flags that are never NULL."""
    flagged = staged.withColumns(
        {
            "is_qc_pass": flag(F.col("qc_flag") == "Pass"),
            "is_control": flag(F.col("control_type") != "Test Article"),
        }
    )
    return flagged.select(*FACT_COLUMNS)
