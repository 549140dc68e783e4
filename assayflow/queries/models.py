"""The model set over the laboratory tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayflow.plans.dimensions import candidate_dim as build_candidate_dim
from assayflow.plans.facts import fact_results as build_fact
from assayflow.plans.marts import candidate_mart as build_candidate_mart
from assayflow.plans.marts import experiment_mart as build_experiment_mart
from assayflow.plans.profiles import COMPAT, STRICT, Profile
from assayflow.plans.staging import enrich_lifecycle
from assayflow.plans.staging import stage_experiments as build_experiments
from assayflow.plans.staging import stage_results as build_results
from assayflow.plans.staging import stage_samples as build_samples
from assayflow.plans.staging import stage_stocks as build_stocks
from assayflow.queries.base import query
from assayflow.queries.lab import (
    AS_OF,
    lab_sql,
    raw_experiments,
    raw_samples,
    raw_screening_results,
    raw_stocks,
)


@query(lab_sql("select * from stg_experiments"))
def stage_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_experiments(raw_experiments(spark, sf_dir))


@query(lab_sql("select * from stg_samples"))
def stage_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_samples(raw_samples(spark, sf_dir))


@query(lab_sql("select * from stg_stocks"))
def stage_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_stocks(raw_stocks(spark, sf_dir))


@query(lab_sql("select * from stg_screening_results"))
def stage_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_results(raw_screening_results(spark, sf_dir))


@query(lab_sql("select * from int_experiments"))
def lifecycle_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_lifecycle(build_experiments(raw_experiments(spark, sf_dir)))


def _fact(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return build_fact(build_results(raw_screening_results(spark, sf_dir), profile))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples, stocks = build_samples(raw_samples(spark, sf_dir)), build_stocks(raw_stocks(spark, sf_dir))
    return build_candidate_dim(samples, stocks, AS_OF)


@query(lab_sql("select * from fct_screening_results"))
def fact_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, COMPAT)


@query(lab_sql("select * from fct_replicates"))
def fact_results_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, STRICT)


@query(lab_sql("select * from dim_antibody_candidates"))
def candidate_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _candidates(spark, sf_dir)


@query(lab_sql("select * from mart_antibody_candidate_summary"))
def candidate_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_candidate_mart(_candidates(spark, sf_dir), _fact(spark, sf_dir, COMPAT))


@query(lab_sql("select * from mart_candidate_replicates"))
def candidate_mart_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_candidate_mart(_candidates(spark, sf_dir), _fact(spark, sf_dir, STRICT))


@query(lab_sql("select * from mart_experiment_summary"))
def experiment_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_experiment_mart(lifecycle_enrich(spark, sf_dir), _fact(spark, sf_dir, COMPAT))


@query(lab_sql("select * from mart_experiment_replicates"))
def experiment_mart_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_experiment_mart(lifecycle_enrich(spark, sf_dir), _fact(spark, sf_dir, STRICT))
