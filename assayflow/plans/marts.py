"""The two summary tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayflow.functions import flag, month_start, safe_ratio
from assayflow.operators.joins import left_join_fanout

# What describes a candidate.
CANDIDATE = (
    "sample_id",
    "sample_name",
    "internal_code",
    "antibody_clone_id",
    "antibody_target_antigen",
    "antibody_format",
    "antibody_humanized",
)


@dataclass(frozen=True)
class CandidateRules:
    """Endpoints averaged per candidate and the limits of the recommendation."""

    # Endpoint names and limits.
    affinity: tuple[str, ...] = ("Binding Affinity",)
    cytotoxicity: tuple[str, ...] = ("Cytotoxicity",)
    cytokine: tuple[str, ...] = ("IFN-gamma", "IL-2")
    activation: tuple[str, ...] = ("CD69 Positive T Cells", "Reporter Inhibition")
    max_affinity_nm: float = 50
    min_cytotoxicity: float = 50
    min_pass_rate: float = 0.9
    review_pass_rate: float = 0.8


def average_of(endpoints: tuple[str, ...]) -> Column:
    """Average value over some endpoints; other rows do not count."""
    return F.avg(F.when(F.col("endpoint_name").isin(*endpoints), F.col("endpoint_value")))


def recommendation(rules: CandidateRules) -> Column:
    """First rule that holds, in this order."""
    pass_rate = F.coalesce("qc_pass_rate", F.lit(0))
    cytotoxicity = F.coalesce("avg_cytotoxicity_percent", F.lit(0))
    advance = (
        (F.col("avg_binding_affinity_nm") <= rules.max_affinity_nm)
        & (cytotoxicity >= rules.min_cytotoxicity)
        & (pass_rate >= rules.min_pass_rate)
    )
    return F.when(advance, "Advance").when(pass_rate < rules.review_pass_rate, "Review QC").otherwise("Hold")


def candidate_mart(candidates: DataFrame, results: DataFrame, rules: CandidateRules = CandidateRules()) -> DataFrame:
    """One row per candidate: stocks, tests, averages, pass rate, recommendation.

    Equals a left join of candidates and results on sample and stock, grouped by the candidate's
    attributes. The counts of stocks depend on the candidates alone and are made there;
    results are grouped by the sample and a digest of its other attributes and only then meet
    these. Every grouping combines on the map side, and the inner join may be split on
    either side, so a sample or stock that holds most rows is shared by many tasks.
    """
    attributes = [c for c in CANDIDATE if c != "sample_id"]
    # NULLs are left out of the JSON text, so they differ from every value and equal each other.
    described = candidates.withColumn("variant", F.unhex(F.md5(F.to_json(F.struct(*attributes)).cast("binary"))))
    candidate = ["sample_id", "variant"]
    usable = F.max((~F.col("is_expired") & ~F.col("is_depleted")).cast("int"))
    per_stock = described.groupBy(*candidate, "stock_id").agg(
        *(F.min(c).alias(c) for c in attributes), usable.alias("usable"), F.max("ingest_date").alias("ingest_date")
    )
    sides = per_stock.groupBy(*candidate).agg(
        *(F.min(c).alias(c) for c in attributes),
        F.count("stock_id").alias("num_available_stocks"),
        F.count_if((F.col("usable") == 1) & F.col("stock_id").isNotNull()).alias("num_usable_stocks"),
        F.max("ingest_date").alias("latest_candidate_ingest_date"),
    )
    tested = described.select(*candidate, "stock_id").join(
        results.select(
            "sample_id", "stock_id", "experiment_id", "result_id", "endpoint_name", "endpoint_value", "is_qc_pass", "ingest_date"
        ),
        ["sample_id", "stock_id"],
    )
    tests = tested.groupBy(*candidate).agg(
        F.countDistinct("experiment_id").alias("num_experiments"),
        F.countDistinct("stock_id").alias("num_stocks_tested"),
        F.count("result_id").alias("num_screening_results"),
        average_of(rules.affinity).alias("avg_binding_affinity_nm"),
        average_of(rules.cytotoxicity).alias("avg_cytotoxicity_percent"),
        average_of(rules.cytokine).alias("avg_cytokine_release_pg_ml"),
        average_of(rules.activation).alias("avg_activation_or_inhibition_percent"),
        safe_ratio(F.count_if("is_qc_pass"), F.count("result_id")).alias("qc_pass_rate"),
        F.max("ingest_date").alias("latest_screening_ingest_date"),
    )
    counted = ("num_experiments", "num_stocks_tested", "num_screening_results")
    summary = sides.join(tests, candidate, "left").fillna(0, list(counted))
    columns = [*CANDIDATE, "num_available_stocks", "num_usable_stocks", *tests.columns[2:], "latest_candidate_ingest_date"]
    return summary.select(*columns).withColumn("candidate_recommendation", recommendation(rules))


# Columns of the summary.
EXPERIMENT = (
    "experiment_id",
    "experiment_name",
    "project",
    "experiment_status",
    "run_date",
    "run_month",
    "experiment_author",
    "protocol_name",
    "protocol_code",
    "protocol_version",
    "created_at",
    "signed_at",
    "witnessed_at",
    "is_signed",
    "is_witnessed",
    "days_created_to_signed",
    "days_signed_to_witnessed",
)

EXPERIMENT_RESULT = (
    "result_id",
    "sample_id",
    "stock_id",
    "assay_name",
    "endpoint_name",
    "instrument_name",
    "is_qc_pass",
)


def compliance_status() -> Column:
    signed, witnessed = F.col("is_signed"), F.col("is_witnessed")
    return (
        F.when(signed & witnessed, "Complete")
        .when(signed & ~witnessed, "Signed Not Witnessed")
        .when(~signed, "Unsigned")
        .otherwise("Other")
    )


def complete_within(days: int) -> Column:
    """Signed and witnessed, each stage within the given days; an unknown duration counts as zero."""
    stages = ("days_created_to_signed", "days_signed_to_witnessed")
    to_sign, to_witness = (F.coalesce(stage, F.lit(0)) <= days for stage in stages)
    return flag(F.col("is_signed") & F.col("is_witnessed") & to_sign & to_witness)


def experiment_mart(experiments: DataFrame, results: DataFrame) -> DataFrame:
    """Experiments with each of their results; an experiment without result is kept once."""
    tested = results.select(
        "experiment_id",
        F.lit(True).alias("has_result"),
        *EXPERIMENT_RESULT,
        F.col("ingest_date").alias("screening_result_ingest_date"),
    )
    dated = experiments.withColumn("run_month", month_start(F.col("run_date")))
    joined = left_join_fanout(
        dated.select(*EXPERIMENT, F.col("ingest_date").alias("experiment_ingest_date")), tested, ["experiment_id"]
    )
    passed = F.col("is_qc_pass")
    return joined.select(
        *EXPERIMENT,
        compliance_status().alias("compliance_status"),
        complete_within(7).alias("is_compliance_complete_within_7_days"),
        flag(F.col("has_result")).alias("has_screening_result"),
        *EXPERIMENT_RESULT,
        F.when(passed, "QC Pass").when(~passed, "QC Fail").otherwise("No Result").alias("qc_status"),
        "screening_result_ingest_date",
        "experiment_ingest_date",
    )
