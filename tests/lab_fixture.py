"""Hand-made landed records over two days, and a writer for them."""

from __future__ import annotations

import datetime as dt
import json

from assayflow.plans.pipeline import Pipeline
from assayflow.sources.raw import ingest_files
from assayflow.sources.registry import DATASETS

AS_OF = dt.date(2026, 6, 15)
D1, D2 = dt.date(2026, 6, 1), dt.date(2026, 6, 2)
RUN = dt.datetime(2026, 6, 15, 6, 0)


def experiment(id, status, created, signed, witnessed):
    return {
        "experiment": {"id": id, "project": "PRJ001", "name": f" {id} ", "status": status, "run_date": "2024-01-15"},
        "people": {"author": "Ann", "witnessed_by": None},
        "protocol": {"protocol_name": "P", "protocol_code": "ICI-1009", "protocol_version": "v1"},
        "timestamps": {"created_at": created, "signed_at": signed, "witnessed_at": witnessed},
    }


def sample(id, kind, name="Sample", **fields):
    common = {
        "id": id,
        "sample_name": name,
        "internal_code": id,
        "sample_type": kind,
        "created_by": "Bob",
        "created_at": "2024-01-01 08:00:00",
        "updated_at": "2024-01-02 08:00:00",
    }
    return {"common": common, kind: fields}


def stock(id, sample_id, quantity, expiry):
    return {
        "id": id,
        "sample_id": sample_id,
        "stock_owner": "Bob",
        "lot_number": "L1",
        "quantity": quantity,
        "quantity_unit": "mg",
        "concentration": 1.5,
        "concentration_unit": "mg/mL",
        "storage_location": "F1",
        "created_at": "2024-01-01 08:00:00",
        "stored_at": "",
        "expiry_date": expiry,
        "updated_at": "",
    }


def result(result_id, measurement_id, experiment_id, code, endpoint, replicate, value, supporting):
    return {
        "result_id": result_id,
        "measurement_id": measurement_id,
        "experiment_id": experiment_id,
        "stock_id": "K1",
        "sample_id": "A1",
        "supporting_materials": [dict(zip(("sample_id", "stock_id", "sample_type"), s)) for s in supporting],
        "protocol_code": code,
        "protocol_name": "P",
        "protocol_version": "v1",
        "antibody_clone_id": "CL",
        "antibody_target_antigen": "PD-1",
        "antibody_format": "IgG1",
        "antibody_humanized": True,
        "assay_category": "C",
        "assay_name": "N",
        "endpoint_name": endpoint,
        "endpoint_unit": "u",
        "endpoint_value": value,
        "treatment_concentration": 1,
        "treatment_concentration_unit": "nM",
        "control_type": "Test Article",
        "replicate_number": replicate,
        "replicates_expected": 2,
        "measurement_timepoint_hours": 0,
        "instrument_name": "I",
        "qc_flag": "Pass",
    }


PAIRS = [("P1", "KP", "pbmc"), ("C1", "KC", "cell_line")]

LANDED = {
    D1: {
        "experiments": [
            experiment("E1", "Draft", "2024-01-01 23:00:00", None, None),
            experiment("E2", "Witnessed", "2024-01-02 08:00:00", "2024-01-05 08:00:00", "2024-01-12 09:00:00"),
            experiment("E3", "Witnessed", "2024-01-02 08:00:00", "2024-01-10 07:59:59", "2024-01-18 08:00:00"),
            experiment("E4", "In Review", "2024-01-02 08:00:00", "", ""),
        ],
        "samples": [
            sample("A1", "antibody_candidate", "\tAlpha Sample ", antibody_clone_id="CL", antibody_humanized=True),
            sample("A2", "antibody_candidate"),
            sample("P1", "pbmc", pbmc_donor_id="D"),
            sample("C1", "cell_line", cell_line_passage_number=7),
        ],
        "stocks": [
            stock("K1", "A1", 10.0, "2026-06-20"),
            stock("K2", "A1", 0.0, "2026-06-20"),
            stock("K3", "A1", 5.0, "2026-06-14"),
            stock("K4", "A1", 5.0, ""),
            stock("KP", "P1", 5.0, "2026-07-01"),
            stock("KC", "C1", 5.0, "2026-07-01"),
        ],
        "screening_results": [
            result("R1", "M1", "E2", "ICI-1009", "Binding Affinity", 1, 40.0, []),
            result("R1", "M1", "E2", "ICI-1009", "Binding Affinity", 2, 60.0, []),
            result("R2", "M2", "E3", "ICI-1005", "Cytotoxicity", 1, 80.0, PAIRS),
        ],
    },
    D2: {"experiments": [experiment("E1", "Signed", "2024-01-01 23:00:00", "2024-01-03 01:00:00", None)]},
}


def land(root: str, day: dt.date) -> dict[str, list[str]]:
    """Write the records of one day as landed files; returns the paths per dataset."""
    paths = {}
    for name, records in LANDED[day].items():
        folder = root / "ingest" / name / f"run_date={day}"
        folder.mkdir(parents=True, exist_ok=True)
        file = folder / "06-00-00.json"
        file.write_text(json.dumps(records, indent=2))
        paths[name] = [str(file)]
    return paths


def ingest(pipeline: Pipeline, root, day: dt.date) -> None:
    for name, paths in land(root, day).items():
        ingest_files(pipeline.spark, DATASETS[name], paths, str(root), day, pipeline.profile.arrays)
