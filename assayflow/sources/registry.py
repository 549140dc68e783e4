"""The four datasets: landing schema, raw schema, key and version order.

Field order matters. Flattening lets a later field replace an earlier one of the
same name, so landing schemas are written in document order and never inferred
(inference sorts the fields).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T
from pyspark.sql.types import StructType

# Field names, order and types of the landed records.
_EXPERIMENTS = """
    experiment struct<id: string, project: string, name: string, status: string, run_date: string>,
    people struct<author: string, witnessed_by: string>,
    protocol struct<protocol_name: string, protocol_code: string, protocol_version: string>,
    timestamps struct<created_at: string, signed_at: string, witnessed_at: string>
"""
_SAMPLES = """
    common struct<id: string, sample_name: string, internal_code: string, sample_type: string,
                  created_by: string, created_at: string, updated_at: string>,
    cell_line struct<cell_line_name: string, cell_line_tissue_origin: string,
                     cell_line_passage_number: int>,
    plasma_fraction struct<plasma_fraction_type: string, plasma_donor_pool_size: int,
                           plasma_pathogen_screening_status: string,
                           plasma_storage_temperature_c: int>,
    protein_extract struct<protein_source_material: string, protein_lysis_buffer: string,
                           protein_yield_mg: double, protein_purity_percent: double>,
    tumor_sample struct<tumor_type: string, tumor_stage: string, tumor_collection_site: string,
                        tumor_necrosis_percent: double>,
    pbmc struct<pbmc_donor_id: string, pbmc_viability_percent: double,
                pbmc_isolation_method: string, pbmc_cryopreserved: boolean>,
    antibody_candidate struct<antibody_format: string, antibody_target_antigen: string,
                              antibody_clone_id: string, antibody_binding_affinity_nm: double,
                              antibody_humanized: boolean>
"""
_STOCKS = """
    id string, sample_id string, stock_owner string, lot_number string,
    quantity double, quantity_unit string, concentration double, concentration_unit string,
    storage_location string, created_at string, stored_at string, expiry_date string,
    updated_at string
"""
_SCREENING_RESULTS = """
    result_id string, measurement_id string, experiment_id string, stock_id string,
    sample_id string,
    supporting_materials array<struct<sample_id: string, stock_id: string, sample_type: string>>,
    protocol_code string, protocol_name string, protocol_version string,
    antibody_clone_id string, antibody_target_antigen string, antibody_format string,
    antibody_humanized boolean, assay_category string, assay_name string,
    endpoint_name string, endpoint_unit string, endpoint_value double,
    treatment_concentration double, treatment_concentration_unit string, control_type string,
    replicate_number int, replicates_expected int, measurement_timepoint_hours double,
    instrument_name string, qc_flag string
"""


@dataclass(frozen=True)
class Dataset:
    """One landed dataset and how its raw table is keyed."""

    name: str
    landing_ddl: str
    key: str

    @property
    def landing_schema(self) -> StructType:
        return T.StructType.fromDDL(self.landing_ddl)

    def landing_path(self, root: str) -> str:
        return f"{root.rstrip('/')}/ingest/{self.name}"

    def raw_path(self, root: str) -> str:
        return f"{root.rstrip('/')}/raw/{self.name}"


DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("experiments", _EXPERIMENTS, "id"),
        Dataset("samples", _SAMPLES, "id"),
        Dataset("stocks", _STOCKS, "id"),
        Dataset("screening_results", _SCREENING_RESULTS, "result_id"),
    )
}


def dataset(name: str) -> Dataset:
    """Look a dataset up by name; an unknown name lists the known ones."""
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}, expected one of {sorted(DATASETS)}")
    return DATASETS[name]
