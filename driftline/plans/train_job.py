"""Processed bookings to an evaluated, profiled and logged model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import evaluation, modeling
from ..operators.cleaning import training_period
from ..operators.contracts import leak_guard, require_inputs, validate_processed
from ..operators.drift import reference_profile
from ..operators.features import BOOKING_SPEC, MEASURED, ModelInputs
from ..operators.lineage import run_facts, run_tags
from ..operators.sampling import stratified_split
from ..runtime import stage_table
from ..sources.stores import PerformanceStore, ProfileStore, RunStore


@dataclass(frozen=True)
class TrainSettings:
    """Split, search and gate of a training run."""

    # The defaults of a run.
    label: str = "market_segment"
    year_col: str = "arrival_date_year"
    max_year: int | None = None
    validation: float = 0.2
    test: float = 0.2
    seed: int = 42
    n_trials: int = 8
    min_f1: float = 0.60
    backtest: bool = True
    trials: tuple[modeling.ForestParams, ...] = ()


@dataclass(frozen=True)
class TrainedRun:
    run_id: str
    model: PipelineModel
    best: modeling.ForestParams
    metrics: dict[str, float]
    gate: str
    profile: DataFrame
    report: DataFrame
    confusion: DataFrame
    auc: DataFrame
    facts: DataFrame = field(repr=False)

    @property
    def performance(self) -> dict[str, float]:
        """What promotion compares."""
        return {
            "f1_weighted": self.metrics["f1_score"],
            "accuracy": self.metrics["accuracy"],
            "n_eval": int(self.metrics["n_eval"]),
        }


def train(
    df: DataFrame,
    key: str,
    run_id: str,
    spec: ModelInputs = BOOKING_SPEC,
    settings: TrainSettings = TrainSettings(),
    tags: dict[str, str] | None = None,
) -> TrainedRun:
    """Validate, split, search, refit, score the test rows once, profile and judge.

    ``key`` identifies a row; the splits are drawn from it. The split rows are staged, so
    that every later pass reads the columns it needs from one table.
    """
    leak_guard(spec)
    label = settings.label
    rows = validate_processed(df)
    if settings.max_year:
        rows = validate_processed(training_period(rows, settings.max_year, settings.year_col))
    require_inputs(rows, [*spec.sources(), label])
    wanted = [key, label, *spec.sources()]
    wanted += [c for c in (settings.year_col,) if c in rows.columns and c not in wanted]
    split = stage_table(
        stratified_split(
            rows.select(*wanted), label, key, settings.seed, settings.validation, settings.test
        ),
        "split",
    )
    train_rows, validation_rows, test_rows = (
        split.filter(F.col("split") == name) for name in ("train", "validation", "test")
    )
    trials = list(settings.trials) or modeling.draw_trials(settings.n_trials, settings.seed)
    found = modeling.search(train_rows, validation_rows, spec, label, trials, settings.seed)
    model = modeling.refit_train_val(
        train_rows, validation_rows, spec, label, found.best, settings.seed
    )
    fit_rows = train_rows.unionByName(validation_rows)

    classes = modeling.classes_of(model)
    # the test rows are scored once; all reports read the staged result
    scored = stage_table(
        model.transform(test_rows).select(
            F.col(label).cast("string").alias("true"),
            F.col("predicted_segment").alias("predicted"),
            vector_to_array("probability").alias("probabilities"),
        ),
        "scored",
    )
    counts = evaluation.confusion_counts(scored, "true", "predicted")
    summary = evaluation.summary_scores(counts).first()
    auc = evaluation.roc_auc_ovr(
        scored, "true", {c: F.col("probabilities")[i] for i, c in enumerate(classes)}
    )
    naive = modeling.majority_baseline(fit_rows, test_rows, label)
    floor = evaluation.summary_scores(
        evaluation.confusion_counts(naive, label, "predicted_segment")
    ).first()
    metrics = {
        "val_f1_best": found.best_score,
        "val_f1_default": found.default_score,
        "f1_score": summary.weighted_f1,
        "f1_macro": summary.macro_f1,
        "accuracy": summary.accuracy,
        "n_eval": summary.n,
        "roc_auc_ovr_macro": evaluation.roc_auc_macro(auc).first()[0],
        "baseline_f1_score": floor.weighted_f1,
        "baseline_f1_macro": floor.macro_f1,
    }
    if settings.backtest and settings.year_col in split.columns:
        later = modeling.temporal_backtest(
            split, spec, label, settings.year_col, found.best, settings.seed
        )
        if later is not None:
            last = later.first()
            metrics["temporal_f1_score"] = last.f1_weighted
            metrics["temporal_f1_macro"] = last.f1_macro
    gate = evaluation.quality_gate(metrics["f1_score"], settings.min_f1)
    facts = run_facts(
        df.sparkSession,
        run_id,
        params=found.best.as_dict(),
        metrics=metrics,
        tags={**(tags or {}), "quality_gate": gate},
    )
    return TrainedRun(
        run_id,
        model,
        found.best,
        metrics,
        gate,
        reference_profile(fit_rows, spec.sources(*MEASURED)),
        evaluation.classification_report(counts),
        evaluation.confusion_matrix(scored, "true", "predicted", classes),
        auc,
        facts,
    )


def artifacts(run: TrainedRun) -> DataFrame:
    """(run_id, kind, key, value): report and confusion matrix as JSON, AUC per class as metrics."""
    def document(table: DataFrame, order: list[str], key: str) -> DataFrame:
        rows = F.sort_array(F.collect_list(F.struct(*order, *[c for c in table.columns if c not in order])))
        return table.agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias("value")).select(
            F.lit("artifact").alias("kind"), F.lit(key).alias("key"), "value"
        )

    auc = run.auc.select(
        F.lit("metric").alias("kind"),
        F.concat(F.lit("roc_auc_"), "label").alias("key"),
        F.col("auc").cast("string").alias("value"),
    )
    found = (
        document(run.report, ["label"], "evaluation/classification_report.json")
        .unionByName(document(run.confusion, ["true", "predicted"], "evaluation/confusion_matrix.json"))
        .unionByName(auc)
    )
    return found.select(F.lit(run.run_id).alias("run_id"), "kind", "key", "value")


def record(
    run: TrainedRun,
    model_version: str,
    runs: RunStore,
    profiles: ProfileStore,
    model_path: str,
    min_f1: float = TrainSettings.min_f1,
    performance: PerformanceStore | None = None,
    lineage: DataFrame | None = None,
) -> None:
    """Log everything, then raise if the run missed the bar: a failed run stays logged.

    ``lineage`` are the tags of ``run_tags``; without them the run carries their "unknown"
    values, so that no run is without.
    """
    known = run.facts.unionByName(artifacts(run))
    tags = run_tags(runs.spark, run.run_id) if lineage is None else lineage
    tags = tags.join(known.filter("kind = 'tag'").select("key"), "key", "left_anti")
    runs.log(known.unionByName(tags.select(*known.columns)), run.run_id)
    profiles.write_profile(run.profile, model_version)
    if performance is not None:
        performance.write_performance(run.run_id, run.performance)
    run.model.write().overwrite().save(model_path)
    evaluation.enforce_gate(run.run_id, run.metrics["f1_score"], min_f1)
