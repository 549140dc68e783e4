"""One run over all layers, in dependency order."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.operators.incremental import since
from assayflow.operators.quality import ROW_CHECKS, Check, ChecksFailed, freshness, observed, run_checks
from assayflow.plans.checks import FRESHNESS_DAYS, declared_checks
from assayflow.plans.dimensions import candidate_dim
from assayflow.plans.facts import fact_results
from assayflow.plans.marts import candidate_mart, experiment_mart
from assayflow.plans.profiles import COMPAT, Profile
from assayflow.plans.staging import enrich_lifecycle, stage_experiments, stage_results, stage_samples, stage_stocks
from assayflow.sources.passes import in_passes, shuffles_deleted
from assayflow.sources.raw import raw_schema, scan_raw
from assayflow.sources.registry import DATASETS
from assayflow.sources.tables import Table

UPDATED_AT = "dbt_updated_at"
BUILT = ("dim_antibody_candidates", "mart_antibody_candidate_summary", "mart_experiment_summary")
#: Merged tables that are laid out by day, as a load mostly brings new rows.
BY_DAY = ("fct_screening_results",)
#: The staged views that come before each merged table.
STAGES = {
    "dim_experiments": ("stg_experiments", "int_experiments"),
    "dim_samples": ("stg_samples",),
    "dim_stocks": ("stg_stocks",),
    "fct_screening_results": ("stg_screening_results",),
}
#: What each table is made of or checked against, in build order.
NEEDS = {
    "dim_experiments": (),
    "dim_samples": (),
    "dim_stocks": ("dim_samples",),
    "fct_screening_results": ("dim_experiments", "dim_samples", "dim_stocks"),
    "dim_antibody_candidates": ("dim_samples", "dim_stocks"),
    "mart_antibody_candidate_summary": ("dim_antibody_candidates", "fct_screening_results"),
    "mart_experiment_summary": ("dim_experiments", "fct_screening_results"),
}


@dataclass(frozen=True)
class Pipeline:
    """The model set over one root folder.

    ``buckets`` is the layout of the merged tables: pick it for the expected size
    before the first run; stored tables keep theirs. ``keep`` published states of each
    table stay readable after a build, older files are deleted.
    """

    spark: SparkSession
    root: str
    profile: Profile = COMPAT
    buckets: int | None = None
    keep: int = 3

    def raw(self, name: str) -> DataFrame:
        ds = DATASETS[name]
        return scan_raw(self.spark, ds.raw_path(self.root), raw_schema(self.spark, ds, self.profile.arrays))

    def table(self, name: str) -> Table:
        keys = {k: v for k, (v, _, _) in self.merged_models.items()}.get(name, ())
        return Table(self.spark, f"{self.root}/tables/{name}", keys, self.buckets, layout="days" if name in BY_DAY else "keys")

    @cached_property
    def merged_models(self) -> dict[str, tuple[tuple[str, ...], str, Callable[[DataFrame], DataFrame]]]:
        """Merged table: its key, its dataset, and the model from raw rows to its rows."""
        return {
            "dim_experiments": (
                ("experiment_id",),
                "experiments",
                lambda raw: enrich_lifecycle(stage_experiments(raw)),
            ),
            "dim_samples": (("sample_id",), "samples", stage_samples),
            "dim_stocks": (("stock_id",), "stocks", stage_stocks),
            "fct_screening_results": (
                self.profile.fact_key,
                "screening_results",
                lambda raw: fact_results(stage_results(raw, self.profile)),
            ),
        }

    def _slice(self, name: str, raw: DataFrame | None = None) -> DataFrame:
        """The raw days a merged table has yet to take: all, or those not older than its newest day, as the table states it."""
        _, dataset, _ = self.merged_models[name]
        source, target = self.raw(dataset) if raw is None else raw, self.table(name)
        return since(source, target.newest_day(), self.profile.empty_loads_all) if target.exists() else source

    def merge_model(self, name: str, run_ts: datetime, raw: DataFrame | None = None, gate: bool = False) -> None:
        """Bring one merged table up to date from the raw days not older than its newest day.

        With ``gate`` the slice must pass the checks of its raw table and staged views first. Many rows are
        staged in passes: a pass has all versions of its keys.
        """
        _, dataset, model = self.merged_models[name]
        source = self._slice(name, raw)
        if gate:
            self._check_slice(name, dataset, source)
        parts = in_passes(source, DATASETS[dataset].key)
        self._store(name, [stamp(model(part), run_ts) for part in parts], gate, merge=True)

    def _check_slice(self, name: str, dataset: str, source: DataFrame) -> None:
        staged = {
            "stg_experiments": stage_experiments,
            "int_experiments": lambda raw: enrich_lifecycle(stage_experiments(raw)),
            "stg_samples": stage_samples,
            "stg_stocks": stage_stocks,
            "stg_screening_results": lambda raw: stage_results(raw, self.profile),
        }
        views = {f"raw_{dataset}": source} | {view: staged[view](source) for view in STAGES[name]}
        checks = [c for c in self.gating if c.table in views]
        with shuffles_deleted(self.spark):
            failed = run_checks(views, checks).filter("status = 'fail'").collect()  # at most one row per check
        if failed:
            raise ChecksFailed(name, {f"{r.table}.{r.column} {r.check}": r.failures for r in failed})

    @cached_property
    def gating(self) -> list[Check]:
        """The checks that a gated build asks for: the declared ones, unless the profile's grain breaks them by design."""
        return [c for c in declared_checks() if (c.table, c.column, c.kind) not in self.profile.waived]

    def _store(self, name: str, rows: DataFrame | Sequence[DataFrame], gate: bool, merge: bool) -> None:
        """Write one table, the rows of a merge also frame by frame; with ``gate`` publish it only if it passes its checks.

        Checks of single rows are counted while the rows are written, the others read what was written.
        """
        table, approve = self.table(name), None
        frames = [rows] if isinstance(rows, DataFrame) else list(rows)
        if gate:
            own = [c for c in self.gating if c.table == name]
            frames, found = zip(*(observed(frame, own) for frame in frames))
            # A merge has unique keys, or it fails.
            others = [c for c in own if c.kind not in ROW_CHECKS and not (merge and c.kind == "unique" and [c.column] == table.keys)]
            parents = {c.parent for c in others if c.parent}

            def approve(written: DataFrame) -> None:
                failures = dict(sum((Counter(f()) for f in found), Counter()))
                if others and not failures:
                    tables = {name: written} | {parent: self.table(parent).read() for parent in parents}
                    failed = run_checks(tables, others).filter("status = 'fail'").collect()
                    failures = {f"{r.column} {r.check}": r.failures for r in failed}
                if failures:
                    raise ChecksFailed(name, failures)

        table.merge(frames, approve) if merge else table.overwrite(*frames, approve)

    def _rebuild(self, name: str, run_ts: datetime, as_of: date, gate: bool) -> None:
        read = lambda parent: self.table(parent).read()
        if name == "dim_antibody_candidates":
            rows = candidate_dim(read("dim_samples"), read("dim_stocks"), as_of)
        elif name == "mart_antibody_candidate_summary":
            rows = candidate_mart(read("dim_antibody_candidates"), read("fct_screening_results"))
        else:
            rows = experiment_mart(read("dim_experiments"), read("fct_screening_results"))
        self._store(name, stamp(rows, run_ts), gate, merge=False)

    def build(self, run_ts: datetime, as_of: date, gate: bool = False) -> dict[str, str]:
        """All tables: merge dimensions and fact, then rebuild the wide dimension and the marts.

        With ``gate`` a table is published only if it passes its declared checks; one that does not
        keeps its former rows, and what depends on it is skipped. Returns per table "built", what
        failed, or which table it was skipped for.
        """
        outcome: dict[str, str] = {}
        for name, needs in NEEDS.items():
            lost = [n for n in needs if outcome[n] != "built"]
            if lost:
                outcome[name] = f"skipped: {', '.join(lost)}"
                continue
            try:
                if name in self.merged_models:
                    self.merge_model(name, run_ts, gate=gate)
                else:
                    self._rebuild(name, run_ts, as_of, gate)
            except ChecksFailed as failed:
                outcome[name] = f"failed: {failed}"
                continue
            outcome[name] = "built"
            self.table(name).expire(self.keep)
        return outcome

    def layers(self) -> dict[str, DataFrame]:
        """Every table by name: raw scans, staging views and stored tables."""
        raw = {name: self.raw(name) for name in DATASETS}
        staged = {
            "stg_experiments": stage_experiments(raw["experiments"]),
            "stg_samples": stage_samples(raw["samples"]),
            "stg_stocks": stage_stocks(raw["stocks"]),
            "stg_screening_results": stage_results(raw["screening_results"], self.profile),
        }
        staged["int_experiments"] = enrich_lifecycle(staged["stg_experiments"])
        stored = {name: self.table(name).read() for name in (*self.merged_models, *BUILT)}
        return {f"raw_{name}": df for name, df in raw.items()} | staged | stored

    def check(self) -> DataFrame:
        """Results of all declared checks. Each table, and each relationship, is a query of its own, whose shuffles are gone before the next."""
        layers, groups = self.layers(), {}
        for check in declared_checks():
            groups.setdefault((check.table, check.column if check.kind == "relationships" else ""), []).append(check)
        with shuffles_deleted(self.spark):
            found = [row for own in groups.values() for row in run_checks(layers, own).collect()]  # one row per check
        return self.spark.createDataFrame(found, "table string, column string, check string, failures bigint, status string")

    def check_freshness(self, as_of: date) -> dict[str, DataFrame]:
        """Age of the newest load of each raw table."""
        return {name: freshness(self.raw(name), as_of, **FRESHNESS_DAYS) for name in DATASETS}

    def register_views(self) -> None:
        """Make every layer available to ``spark.sql`` under its name."""
        for name, df in self.layers().items():
            df.createOrReplaceTempView(name)


def stamp(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Record which run wrote the row."""
    return df.withColumn(UPDATED_AT, F.lit(run_ts).cast("timestamp_ntz"))
