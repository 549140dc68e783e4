"""The assay catalogue, what it lets us expect, and checks against it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE_DDL = """
    protocol_code string, assay_category string, assay_name string,
    endpoint_names array<string>, endpoint_unit string, min_value double, max_value double,
    concentrations array<double>, timepoints_hours array<int>, replicates_expected int,
    supporting_types array<string>
"""

# The five antibody screening assays.
# fmt: off
ASSAYS = [
    ("ICI-1003", "Cytokine Release", "Cytokine Release ELISA Assay",
     ["IL-2"], "pg/mL", 10.0, 3000.0,
     [0.1, 1.0, 10.0, 100.0], [24], 3, ["pbmc"]),
    ("ICI-1004", "Cytokine Release", "Multiplex Cytokine Panel Assay",
     ["IL-2", "IFN-gamma", "TNF-alpha", "IL-6"], "pg/mL", 10.0, 5000.0,
     [1.0, 10.0, 100.0], [24, 48], 2, ["pbmc"]),
    ("ICI-1005", "Tumor Cell Killing", "Immune Cell Cytotoxicity Assay",
     ["Cytotoxicity"], "%", 5.0, 95.0,
     [0.1, 1.0, 10.0, 100.0], [24, 48, 72], 3, ["pbmc", "cell_line"]),
    ("ICI-1006", "Checkpoint Reporter Activity", "Checkpoint Reporter Gene Assay",
     ["Reporter Inhibition"], "%", 0.0, 100.0,
     [0.01, 0.1, 1.0, 10.0, 100.0], [6, 24], 3, ["cell_line"]),
    ("ICI-1009", "Antibody Binding", "Anti Drug Antibody Screen",
     ["Binding Affinity"], "nM", 0.01, 500.0,
     [1.0], [0], 2, []),
]
# fmt: on


def assay_catalogue(spark: SparkSession) -> DataFrame:
    """One row per assay; five rows, so it is always safe to broadcast."""
    return spark.createDataFrame(ASSAYS, CATALOGUE_DDL)


def with_assay(df: DataFrame, *fields: str, how: str = "left") -> DataFrame:
    """Look fields of the catalogue up by ``protocol_code``."""
    catalogue = assay_catalogue(df.sparkSession).select("protocol_code", *fields)
    return df.join(F.broadcast(catalogue), "protocol_code", how)


def measurement_grid(df: DataFrame) -> DataFrame:
    """Every measurement the assay of a row calls for, one row per replicate.

    The lists of the catalogue row are exploded in place: no join of the parts,
    no shuffle. Rows whose protocol is not in the catalogue expect nothing.
    """
    return (
        with_assay(
            df, "endpoint_names", "concentrations", "timepoints_hours", "replicates_expected", how="inner"
        )
        .withColumn("endpoint_name", F.explode("endpoint_names"))
        .withColumn("treatment_concentration", F.explode("concentrations"))
        .withColumn("measurement_timepoint_hours", F.explode("timepoints_hours"))
        .withColumn("replicate_number", F.explode(F.sequence(F.lit(1), "replicates_expected")))
        .drop("endpoint_names", "concentrations", "timepoints_hours", "replicates_expected")
    )


def out_of_range(results: DataFrame, value: str = "endpoint_value") -> DataFrame:
    """Results whose value lies outside the range of their assay."""
    ranged = with_assay(results, "min_value", "max_value", how="inner")
    return ranged.filter(~F.col(value).between(F.col("min_value"), F.col("max_value")))


def replicate_status(expected: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Observed against expected replicates per measurement.

    ``expected`` has one row per measurement with ``replicates_expected``;
    ``observed`` one row per replicate, counted before the join.
    """
    counts = observed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_observed"))
    n = F.coalesce("n_observed", F.lit(0)).cast("bigint")
    expect = F.col("replicates_expected")
    return (
        expected.join(counts, keys, "left")
        .withColumn("n_observed", n)
        .withColumn(
            "replicate_status",
            F.when(n < expect, "Incomplete").when(n > expect, "Excess").when(n == expect, "Complete"),
        )
    )
