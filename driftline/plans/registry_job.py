"""Promotion, rollback and the drift check as jobs that read stores and write what they decide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.drift import DriftPolicy
from ..operators.lineage import check_facts
from ..operators.promotion import (
    NO_PREDECESSOR,
    TOLERANCE,
    PromotionError,
    canary_tags,
    promotion_verdict,
    resolve_alias,
    rollback_verdict,
)
from ..runtime import Staging, stage_table
from ..sources.stores import BatchTable, PerformanceStore, PredictionLog, ProfileStore, RunStore
from .drift_job import exit_code, run_drift_check

VERSION_SCHEMA = "model string, version string, run_id string, promoted_from_version string"
ALIAS_SCHEMA = "model string, alias string, version string"
VERDICT_SCHEMA = (
    "model string, alias string, run_id string, version string, champion_version string, "
    "challenger_f1 double, champion_f1 double, gap double, verdict string"
)


@dataclass(frozen=True)
class EventTable(BatchTable):
    """A table of events; of each key the newest batch counts. Batches sort by their names."""

    def current(self, keys: list[str], besides: str | None = None) -> DataFrame:
        rows = self.read()
        if besides is not None:
            rows = rows.filter(F.col("batch") < besides)
        rest = [c for c in self.columns() if c not in keys]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("row"))
        return newest.select(*[c if c in keys else F.col("row")[c].alias(c) for c in self.columns()])


@dataclass(frozen=True)
class Registry:
    """Registered versions, aliases, runs and their test scores, below one path."""

    spark: SparkSession
    path: str

    def versions(self) -> EventTable:
        return EventTable(self.spark, f"{self.path}/versions", VERSION_SCHEMA)

    def aliases(self) -> EventTable:
        return EventTable(self.spark, f"{self.path}/aliases", ALIAS_SCHEMA)

    def runs(self) -> RunStore:
        return RunStore(self.spark, f"{self.path}/runs")

    def performance(self) -> PerformanceStore:
        return PerformanceStore(self.spark, f"{self.path}/performance")

    def profiles(self) -> ProfileStore:
        return ProfileStore(self.spark, f"{self.path}/profiles")

    def verdicts(self) -> BatchTable:
        return BatchTable(self.spark, f"{self.path}/verdicts", VERDICT_SCHEMA)

    def current_versions(self, besides: str | None = None) -> DataFrame:
        return self.versions().current(["model", "version"], besides)

    def current_aliases(self, besides: str | None = None) -> DataFrame:
        return self.aliases().current(["model", "alias"], besides)

    def register(self, versions: DataFrame, batch: str) -> None:
        """New versions (model, version, run_id), not promoted yet."""
        rows = versions.withColumn("promoted_from_version", F.lit(None).cast("string"))
        self.versions().write(rows, batch)


def run_gates(runs: DataFrame) -> DataFrame:
    """(run_id, quality_gate) of the logged runs."""
    return (
        runs.filter("kind = 'tag' AND key = 'quality_gate'")
        .groupBy("run_id")
        .agg(F.max_by("value", "batch").alias("quality_gate"))
    )


def promote(
    registry: Registry, candidates: DataFrame, batch: str, tolerance: float = TOLERANCE
) -> DataFrame:
    """Judge candidate runs (run_id, model, alias) and record what follows; returns the verdicts.

    Reads the gates of the runs, versions, aliases and test scores from the registry. Writes the
    moved aliases, the promoted versions with their predecessor, all verdicts, and the canary
    verdict of every run that was compared. Batch names sort in the order of the promotions; a batch that runs
    again sees what was there before it and writes the same. Several promotions of one alias in
    a batch raise before anything is written.
    """
    with Staging(registry.spark) as staging:
        versions = staging.put(registry.current_versions(batch), "versions")
        verdicts = staging.put(
            promotion_verdict(
                candidates,
                run_gates(registry.runs().read().filter(F.col("batch") != f"run-canary-{batch}")),
                versions,
                registry.current_aliases(batch),
                registry.performance().read(),
                tolerance,
            ),
            "verdicts",
        )
        moved = verdicts.filter(F.col("verdict").isin("bootstrap", "accepted"))
        twice = moved.groupBy("model", "alias").count().filter("count > 1").first()
        if twice is not None:
            raise PromotionError(f"two candidates for {twice.model}/{twice.alias}")
        tags = moved.groupBy("model", "version").agg(
            F.max(F.coalesce("champion_version", F.lit(NO_PREDECESSOR))).alias("promoted_from_version")
        )
        promoted = versions.drop("promoted_from_version").join(tags, ["model", "version"])
        registry.versions().write(promoted, batch)
        registry.runs().log(canary_tags(verdicts), f"canary-{batch}")
        # the aliases last: what they point to is known by then
        registry.aliases().write(moved.select("model", "alias", "version"), batch)
        registry.verdicts().write(verdicts, batch)
    return registry.verdicts().read().filter(F.col("batch") == batch).drop("batch")


def roll_back(registry: Registry, model: str, alias: str, batch: str) -> str:
    """Move an alias back by one promotion and return its version; raises without a predecessor."""
    aliases = registry.current_aliases(batch).filter(
        (F.col("model") == model) & (F.col("alias") == alias)
    )
    found = rollback_verdict(aliases, registry.current_versions(batch)).collect()
    if not found or not found[0].ok:
        raise PromotionError(f"'{alias}' of {model} has no recorded previous version")
    back = registry.spark.createDataFrame([(model, alias, found[0].previous)], ALIAS_SCHEMA)
    registry.aliases().write(back, batch)
    return found[0].previous


def check_aliases(
    registry: Registry,
    log: PredictionLog,
    alias: str,
    as_of: Column,
    check_id: str,
    policy: DriftPolicy = DriftPolicy(),
) -> tuple[DataFrame, int]:
    """Test the versions that an alias points to and record the verdicts; (report, exit code).

    The alias is resolved by the registry; a version without a run is an error, one without a
    profile is SKIPPED. Every version's verdict is logged as a run of its own: status, counts,
    scores and the whole report as JSON. The exit code is 1 if one is on ALERT and the policy
    says so, after everything was recorded.
    """
    with Staging(registry.spark) as staging:
        resolved = resolve_alias(registry.current_aliases(), registry.current_versions())
        versions = staging.put(resolved.filter(F.col("alias") == alias), "versions")
        orphan = versions.filter("run_id IS NULL").first()
        if orphan is not None:
            raise PromotionError(f"version {orphan.version} of {orphan.model} has no run on record")
        report = run_drift_check(
            log.live(),
            registry.profiles().read(),
            versions.select(F.col("version").alias("model_version")),
            as_of,
            policy,
        )
        report = stage_table(report, "drift-report")  # it is returned, so it outlives the job
        run_id = F.concat(F.lit(f"{check_id}/"), F.col("model_version"))
        document = F.to_json(F.struct(*report.columns), {"ignoreNullFields": "false"})
        whole = report.select(
            run_id.alias("run_id"),
            F.lit("artifact").alias("kind"),
            F.lit("drift/drift_report.json").alias("key"),
            document.alias("value"),
        )
        registry.runs().log(check_facts(report, run_id).unionByName(whole), check_id)
    return report, exit_code(report, policy)
