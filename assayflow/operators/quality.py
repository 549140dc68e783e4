"""Declarative checks as Spark aggregations and joins.

A check counts failing things: rows for ``not_null``, ``relationships`` and
``expression``, distinct values for ``unique`` and ``accepted_values``. All
checks of one table that need no grouping share one pass over it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from assayflow.functions import calendar_days
from assayflow.operators.joins import orphans
from assayflow.operators.observe import noted

KINDS = ("not_null", "unique", "accepted_values", "relationships", "expression")


@dataclass(frozen=True)
class Check:
    """One declared check.

    ``values`` for accepted_values, ``parent`` and ``parent_column`` for
    relationships, ``expression`` (SQL text) for expression.
    """

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: str = ""
    parent_column: str = ""
    expression: str = ""

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown check {self.kind!r}")


def _finding(check: Check) -> Column:
    """The value a row contributes to a check, as ``(value)``; NULL if it contributes none."""
    value = F.col(check.column)
    if check.kind == "not_null":
        return F.when(value.isNull(), F.struct(F.lit(None).cast("string").alias("value")))
    if check.kind == "expression":
        return F.when(~F.expr(check.expression), F.struct(F.lit(None).cast("string").alias("value")))
    counts = value.isNotNull() if check.kind == "unique" else ~value.isin(*check.values)
    return F.when(counts, F.struct(value.cast("string").alias("value")))


def findings(df: DataFrame, checks: Mapping[int, Check]) -> DataFrame:
    """Rows ``(check_id, value, n_rows)`` for all checks of one table, from one pass over it.

    A row that breaks nothing leaves only the values of unique columns.
    """
    found = F.array(
        *(
            F.when(f.isNotNull(), F.struct(F.lit(i).alias("check_id"), f.getField("value").alias("value")))
            for i, f in ((i, _finding(c)) for i, c in checks.items())
        )
    )
    kept = F.filter(found, lambda x: x.isNotNull())
    return df.select(F.inline(kept)).withColumn("n_rows", F.lit(1).cast("bigint"))


class ChecksFailed(Exception):
    """Rows that must not be published; ``failures`` has how many break each check."""

    def __init__(self, table: str, failures: Mapping[str, int]):
        self.table, self.failures = table, dict(failures)
        super().__init__(f"{table}: " + ", ".join(f"{check} ({n})" for check, n in self.failures.items()))


ROW_CHECKS = ("not_null", "accepted_values", "expression")


def observed(df: DataFrame, checks: Iterable[Check]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The rows, counted by the checks that need no other row while they are written; and what was found, by check, afterwards."""
    own = {f"{c.column} {c.kind}": c for c in checks if c.kind in ROW_CHECKS}
    if not own:
        return df, dict
    metrics = Observation()
    counted = df.observe(metrics, *(F.count_if(_finding(c).isNotNull()).alias(f"c{i}") for i, c in enumerate(own.values())))
    return counted, lambda: {name: n for i, name in enumerate(own) if (n := noted(metrics).get(f"c{i}"))}


def _orphan_findings(check_id: int, check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    lost = orphans(tables[check.table], [check.column], tables[check.parent], [check.parent_column])
    value = F.col(check.column).cast("string").alias("value")
    return lost.select(F.lit(check_id).alias("check_id"), value, "n_rows")


def repeated_values(df: DataFrame, *columns: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their counts."""
    return (
        df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    )


def unaccepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Values outside the list, with their counts; NULL passes."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: table, column, check, failures, status. Lazy, one job.

    Each table is read once for all its checks, and once more per relationship.
    Findings are counted per check and value with a map-side combine; the
    first count removes any hot value before the second.
    """
    numbered = dict(enumerate(checks))
    spark = next(iter(tables.values())).sparkSession
    specs = spark.createDataFrame(
        [(i, c.table, c.column, c.kind) for i, c in numbered.items()],
        "check_id int, table string, column string, check string",
    )
    parts = [_orphan_findings(i, c, tables) for i, c in numbered.items() if c.kind == "relationships"]
    for name in dict.fromkeys(c.table for c in numbered.values()):
        own = {i: c for i, c in numbered.items() if c.table == name and c.kind != "relationships"}
        if own:
            parts.append(findings(tables[name], own))
    per_value = reduce(DataFrame.unionByName, parts).groupBy("check_id", "value").agg(F.sum("n_rows").alias("n"))
    per_check = per_value.groupBy("check_id").agg(
        F.sum("n").alias("n_rows"), F.count("value").alias("n_values"), F.count_if(F.col("n") > 1).alias("n_repeated")
    )
    failures = (
        F.when(F.col("check") == "unique", F.col("n_repeated"))
        .when(F.col("check") == "accepted_values", F.col("n_values"))
        .otherwise(F.col("n_rows"))
    )
    # One row per check at most, so the broadcast is bounded by the number of checks.
    counted = specs.join(F.broadcast(per_check), "check_id", "left")
    return counted.select(
        "table",
        "column",
        "check",
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
        F.when(F.coalesce(failures, F.lit(0)) == 0, "pass").otherwise("fail").alias("status"),
    )


def freshness(
    df: DataFrame, as_of: date, column: str = "ingest_date", warn_after: int = 7, error_after: int = 14
) -> DataFrame:
    """Age in days of the newest load and the verdict. A table without rows is an error."""
    age = calendar_days(F.col("newest"), F.lit(as_of))
    return (
        df.agg(F.max(column).alias("newest"))
        .withColumn("age_days", age)
        .withColumn(
            "status",
            F.when(F.col("age_days") <= warn_after, "pass")
            .when(F.col("age_days") <= error_after, "warn")
            .otherwise("error"),
        )
    )


def partition_row_count(df: DataFrame, day: date, column: str = "ingest_date") -> DataFrame:
    """Rows loaded into one day's partition; none is a failure."""
    return (
        df.filter(F.col(column) == F.lit(day))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .withColumn("status", F.when(F.col("record_count") > 0, "pass").otherwise("fail"))
    )


def status_mismatches(experiments: DataFrame) -> DataFrame:
    """Experiments whose status contradicts their sign-off timestamps."""
    agrees = (
        F.when(F.col("witnessed_at").isNotNull(), F.col("experiment_status") == "Witnessed")
        .when(F.col("signed_at").isNotNull(), F.col("experiment_status") == "Signed")
        .otherwise(F.col("experiment_status").isin("Draft", "In Review"))
    )
    return experiments.filter(~F.coalesce(agrees, F.lit(False)))


def screening_input_failures(results: DataFrame, samples: DataFrame, stocks: DataFrame, protocols: DataFrame) -> DataFrame:
    """Rows per screening input rule broken: protocol, sample type, stock owner.

    Each lookup side is unique on its key. Results are counted once, per protocol, sample and
    stock, so no join sees a hot key. A NULL id is in no catalogue and breaks its rule.
    """
    found = lambda df, keys, name: df.select(*keys, F.lit(True).alias(name))
    counts = results.groupBy("protocol_code", "sample_id", "stock_id").agg(F.count(F.lit(1)).alias("n_rows"))
    antibodies = samples.filter(F.col("sample_type") == "antibody_candidate")
    checked = (
        counts.join(F.broadcast(found(protocols, ["protocol_code"], "known_protocol")), "protocol_code", "left")
        .join(found(antibodies, ["sample_id"], "is_antibody"), "sample_id", "left")
        .join(found(stocks, ["stock_id", "sample_id"], "is_owner"), ["stock_id", "sample_id"], "left")
    )
    rules = {
        "protocol_not_in_catalogue": "known_protocol",
        "sample_not_antibody_candidate": "is_antibody",
        "stock_not_of_sample": "is_owner",
    }
    failures = lambda flag: F.coalesce(F.sum(F.when(F.col(flag).isNull(), F.col("n_rows"))), F.lit(0)).cast("bigint")
    totals = checked.agg(*(failures(flag).alias(rule) for rule, flag in rules.items()))
    listed = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("failures")) for r in rules)))
    return totals.select(listed.alias("of")).select("of.rule", "of.failures")
