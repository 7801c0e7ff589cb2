"""Champion and challenger over tables of runs, versions and aliases.

candidates: run_id, model, alias
runs:       run_id, quality_gate
versions:   model, version, run_id, promoted_from_version
aliases:    model, alias, version
profiles:   run_id, f1_weighted
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import null_safe_join, small_side, stage_table

# How far below the champion a challenger may score, and the tag of a first
# promotion.
TOLERANCE = -0.01
NO_PREDECESSOR = "none"


class PromotionError(Exception):
    """A candidate was refused, or there is nothing to roll back to."""


def resolve_alias(aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """(model, alias, version, run_id)."""
    return aliases.join(versions.select("model", "version", "run_id"), ["model", "version"], "left")


def promotion_verdict(
    candidates: DataFrame,
    runs: DataFrame,
    versions: DataFrame,
    aliases: DataFrame,
    profiles: DataFrame,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One verdict per candidate run; scores are compared as doubles.

    In this order: error_gate, error_candidate (the run has no version, or several), bootstrap,
    noop, error_champion_run, error_profile, rejected, accepted. A score that is null or NaN is
    missing.
    """
    champion = resolve_alias(aliases, versions).select(
        "model",
        "alias",
        F.col("version").alias("champion_version"),
        F.col("run_id").alias("champion_run_id"),
    )
    score = F.col("f1_weighted").cast("double")
    scores = profiles.select("run_id", F.nanvl(score, F.lit(None).cast("double")).alias("f1_weighted"))
    # one row per run, so that a run of several versions does not become several candidates
    registered = versions.groupBy("run_id").agg(
        F.min("version").alias("version"), F.count_distinct("version").alias("n_versions")
    )
    joined = (
        candidates.join(runs.select("run_id", "quality_gate"), "run_id", "left")
        .join(registered, "run_id", "left")
        .join(champion, ["model", "alias"], "left")
        .join(scores.withColumnRenamed("f1_weighted", "challenger_f1"), "run_id", "left")
        .join(
            scores.select(
                F.col("run_id").alias("champion_run_id"), F.col("f1_weighted").alias("champion_f1")
            ),
            "champion_run_id",
            "left",
        )
    )
    gap = F.col("challenger_f1") - F.col("champion_f1")
    passed = F.coalesce(F.col("quality_gate") == "passed", F.lit(False))
    verdict = (
        F.when(~passed, "error_gate")
        .when(F.coalesce("n_versions", F.lit(0)) != 1, "error_candidate")
        .when(F.col("champion_version").isNull(), "bootstrap")
        .when(F.col("champion_version") == F.col("version"), "noop")
        .when(F.col("champion_run_id").isNull(), "error_champion_run")
        .when(gap.isNull(), "error_profile")
        .when(gap < tolerance, "rejected")
        .otherwise("accepted")
    )
    return joined.select(
        "model",
        "alias",
        "run_id",
        F.when(F.col("n_versions") == 1, F.col("version")).alias("version"),
        "champion_version",
        "challenger_f1",
        "champion_f1",
        gap.alias("gap"),
        verdict.alias("verdict"),
    )


def canary_tags(verdicts: DataFrame) -> DataFrame:
    """(run_id, kind, key, value): the verdict of every run that was compared."""
    return verdicts.filter(F.col("verdict").isin("accepted", "rejected")).select(
        "run_id",
        F.lit("tag").alias("kind"),
        F.lit("canary_verdict").alias("key"),
        F.col("verdict").alias("value"),
    )


def apply_promotion(
    verdicts: DataFrame, versions: DataFrame, aliases: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(versions, aliases) after the promotions.

    Two promotions of one (model, alias) raise when a result is read. A version promoted under
    several aliases stays one row and remembers the largest predecessor.
    """
    moved = verdicts.filter(F.col("verdict").isin("bootstrap", "accepted")).select(
        "model",
        "alias",
        "version",
        F.coalesce("champion_version", F.lit(NO_PREDECESSOR)).alias("previous"),
    )
    moved = (
        moved.groupBy("model", "alias")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("version", "previous")).alias("move"))
        .select(
            "model",
            "alias",
            F.when(
                F.col("n") > 1,
                F.raise_error(
                    F.concat(F.lit("two candidates for "), "model", F.lit("/"), "alias")
                ).cast("string"),
            )
            .otherwise(F.col("move.version"))
            .alias("version"),
            F.col("move.previous").alias("previous"),
        )
    )
    tags = moved.groupBy("model", "version").agg(F.max("previous").alias("previous"))
    tagged = versions.join(tags, ["model", "version"], "left").select(
        "model",
        "version",
        "run_id",
        F.coalesce("previous", "promoted_from_version").alias("promoted_from_version"),
    )
    new = moved.select("model", "alias", F.col("version").alias("new_version"))
    pointed = aliases.join(new, ["model", "alias"], "full_outer").select(
        "model", "alias", F.coalesce("new_version", "version").alias("version")
    )
    return tagged, pointed


def rollback_verdict(aliases: DataFrame, versions: DataFrame) -> DataFrame:
    """(model, alias, version, previous, ok): one step back along the recorded lineage."""
    joined = aliases.join(
        versions.select("model", "version", "promoted_from_version"), ["model", "version"], "left"
    )
    known = F.coalesce(F.col("promoted_from_version") != NO_PREDECESSOR, F.lit(False))
    return joined.select(
        "model",
        "alias",
        "version",
        F.when(known, F.col("promoted_from_version")).alias("previous"),
        known.alias("ok"),
    )


def rollback(aliases: DataFrame, versions: DataFrame, model: str, alias: str) -> DataFrame:
    """The aliases with one of them moved back; raises if it has no predecessor."""
    mine = (F.col("model") == model) & (F.col("alias") == alias)
    found = rollback_verdict(aliases.filter(mine), versions).collect()
    if not found or not found[0].ok:
        raise PromotionError(f"'{alias}' of {model} has no recorded previous version")
    return aliases.withColumn(
        "version", F.when(mine, F.lit(found[0].previous)).otherwise(F.col("version"))
    )


# -- history --------------------------------------------------------------------------

# Runs that one task replays; longer histories are cut into more ranges.
RANGE_RUNS = 500_000
# Runs below which a range of its own is not worth a task.
MIN_RANGE_RUNS = 1_000

# Neighbouring ranges that are composed in one group.
FAN = 64

# The functions below run in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STEPS = "model string, chunk int, threshold double, last double, last_version string"
_ENTRY = "model string, chunk int, entry double, entry_version string"
_HISTORY = (
    "model string, run_order bigint, version string, f1 double, verdict string, "
    "champion_version string"
)


def _n_accepted(falling: list[float], champion: float, tolerance: float) -> int:
    """How many of some scores, highest first, are not beyond the tolerance."""
    low, high = 0, len(falling)
    while low < high:
        middle = (low + high) // 2
        if falling[middle] - champion < tolerance:
            high = middle
        else:
            low = middle + 1
    return low


def _steps(f1: list[float], versions: list[str], tolerance: float) -> list[tuple]:
    """Which champion leaves a stretch of runs, for any champion entering it.

    Only a run that beats all runs before it can be the first one promoted, and from there
    on the path is fixed: one row per such run, with the end of its path. Neighbouring runs
    whose paths end alike are one row. With a tolerance of at most 0 every path goes through
    the highest run, so a stretch of any length is one row.
    """
    last = list(range(len(f1)))
    # runs to the right not hidden by a nearer run with at least their score, farthest first
    ahead: list[int] = []
    falling: list[float] = []
    for i in range(len(f1) - 1, -1, -1):
        accepted = _n_accepted(falling, f1[i], tolerance)
        if accepted:
            last[i] = last[ahead[accepted - 1]]
        while falling and falling[-1] <= f1[i]:
            falling.pop()
            ahead.pop()
        falling.append(f1[i])
        ahead.append(i)
    rows, best, end = [], -float("inf"), None
    for i, score in enumerate(f1):
        if score > best:
            best = score
            if last[i] == end:
                rows.pop()
            end = last[i]
            rows.append((score, f1[end], versions[end]))
    return rows


def _chunk_steps(runs: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """The steps of the models at both ends of a range; the others lie inside of it."""
    runs = runs.sort_values(["model", "run_order"], kind="stable")
    chunk = runs["chunk"].iloc[0]
    rows = []
    for model in dict.fromkeys((runs["model"].iloc[0], runs["model"].iloc[-1])):
        mine = runs[(runs["model"] == model) & runs["passed"] & runs["f1"].notna()]
        found = _steps(mine["f1"].tolist(), mine["version"].tolist(), tolerance)
        rows += [(model, chunk, *step) for step in found or [(None, None, None)]]
    return pd.DataFrame(rows, columns=["model", "chunk", "threshold", "last", "last_version"])


def _passed(champion, version, falling: list[float], ends: list[tuple], tolerance: float) -> tuple:
    """The champion that leaves a range, given the one that enters it; ``falling`` thresholds."""
    n = len(falling) if champion is None else _n_accepted(falling, champion, tolerance)
    return ends[n - 1] if n else (champion, version)


def _maps(steps: pd.DataFrame) -> list[tuple]:
    """(range, thresholds from the highest down, ends of their paths) in the order of the ranges."""
    found = []
    for chunk, part in steps.groupby("chunk", sort=True):
        part = part.dropna(subset=["threshold"]).sort_values("threshold", ascending=False)
        found.append((chunk, part["threshold"].tolist(), list(zip(part["last"], part["last_version"]))))
    return found


def _entries(steps: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """The champion entering every range of a model, from the one entering the first of them."""
    first = steps.iloc[0]
    champion, version = (None, None) if pd.isna(first["entry"]) else (first["entry"], first["entry_version"])
    rows = []
    for chunk, falling, ends in _maps(steps):
        rows.append((first["model"], chunk, champion, version))
        champion, version = _passed(champion, version, falling, ends, tolerance)
    return pd.DataFrame(rows, columns=["model", "chunk", "entry", "entry_version"])


def _composed(steps: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """Neighbouring ranges of a model as one: the same rows as a range has, under their block.

    A threshold counts only if it is above all of the ranges before: a champion that it beats
    would have lost to those. Its path goes on through the ranges behind it.
    """
    maps, rows, best = _maps(steps), [], -float("inf")
    for i, (_, falling, ends) in enumerate(maps):
        for threshold, (last, version) in zip(reversed(falling), reversed(ends)):
            if threshold <= best:
                continue
            for _, later, paths in maps[i + 1 :]:
                last, version = _passed(last, version, later, paths, tolerance)
            if rows and rows[-1][3:] == (last, version):
                rows.pop()
            rows.append((steps["model"].iloc[0], steps["block"].iloc[0], threshold, last, version))
        best = max([best, *falling[:1]])
    rows = rows or [(steps["model"].iloc[0], steps["block"].iloc[0], None, None, None)]
    return pd.DataFrame(rows, columns=["model", "chunk", "threshold", "last", "last_version"])


def _chained(steps: DataFrame, n_ranges: int, tolerance: float, fan: int) -> DataFrame:
    """(model, chunk, entry, entry_version), the maps composed as a tree of ``fan`` children.

    A group is at most ``fan`` neighbouring ranges of a model; blocks of ranges are composed, the
    champions entering the blocks are found the same way, and each block hands them on to its
    ranges.
    """
    blocked = steps.withColumn("block", F.floor(F.col("chunk") / fan).cast("int"))
    none = {"entry": F.lit(None).cast("double"), "entry_version": F.lit(None).cast("string")}
    if n_ranges <= fan:
        known = blocked.withColumns(none)
    else:
        blocked = stage_table(blocked, "steps")
        composed = blocked.groupBy("model", "block").applyInPandas(
            lambda part: _composed(part, tolerance), _STEPS
        )
        above = _chained(composed, -(-n_ranges // fan), tolerance, fan)
        known = null_safe_join(
            blocked, above.withColumnRenamed("chunk", "block"), ["model", "block"], "left"
        )
    return known.groupBy("model", "block").applyInPandas(
        lambda part: _entries(part, tolerance), _ENTRY
    )


def _judge(runs: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """Verdict of every run of a range, given the champions that enter it."""
    runs = runs.sort_values(["model", "run_order"], kind="stable")
    verdicts, champions = [], []
    model = champion = current = None
    for name, passed, score, candidate, entry, entry_version in zip(
        runs["model"], runs["passed"], runs["f1"], runs["version"],
        runs["entry"], runs["entry_version"],
    ):
        if name != model:
            model = name
            champion, current = (None, None) if pd.isna(entry) else (entry, entry_version)
        champions.append(current)
        if not passed:
            verdicts.append("error_gate")
            continue
        if pd.isna(score):
            verdicts.append("error_profile")
            continue
        if champion is None:
            verdicts.append("bootstrap")
        elif score - champion < tolerance:
            verdicts.append("rejected")
            continue
        else:
            verdicts.append("accepted")
        champion, current = score, candidate
    judged = runs[["model", "run_order", "version", "f1"]].copy()
    judged["verdict"] = verdicts
    judged["champion_version"] = champions
    return judged


def replay_promotions(
    runs: DataFrame, tolerance: float = TOLERANCE, range_runs: int = RANGE_RUNS, fan: int = FAN
) -> DataFrame:
    """Promote run after run, as if each had been a candidate when it was made.

    runs: model, run_order, version, f1, quality_gate. A verdict depends on the one
    before it, yet no model is replayed in one piece: the runs are cut into ranges in the
    order of model and time; every range tells how it maps a champion entering it to the
    one leaving it (one row if the tolerance is not above 0, and only for the models that cross
    its ends); these maps are composed as a tree of neighbouring ranges; then all ranges are judged side by side. A run whose score is
    missing (null or NaN) is an error_profile and leaves the champion as it is.
    """
    known = runs.select(
        F.col("model").cast("string").alias("model"),
        F.col("run_order").cast("bigint").alias("run_order"),
        F.col("version").cast("string").alias("version"),
        F.col("f1").cast("double").alias("f1"),
        F.coalesce(F.col("quality_gate") == "passed", F.lit(False)).alias("passed"),
    )
    partitions = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_runs = known.count()
    # as many ranges as a small history can use, and never more runs than a task replays
    n_ranges = max(1, min(partitions, n_runs // MIN_RANGE_RUNS), -(-n_runs // range_runs))
    # staged: a range shuffle run again need not cut at the same runs
    ranged = stage_table(
        known.repartitionByRange(n_ranges, "model", "run_order").withColumn(
            "chunk", F.spark_partition_id()
        ),
        "history",
    )
    steps = ranged.groupBy("chunk").applyInPandas(
        lambda chunk: _chunk_steps(chunk, tolerance), _STEPS
    )
    entries = _chained(steps, n_ranges, tolerance, fan)
    crossing = small_side(entries.filter("entry IS NOT NULL"))
    return (
        null_safe_join(ranged, crossing.df, ["model", "chunk"], "left")
        .groupBy("chunk")
        .applyInPandas(lambda chunk: _judge(chunk, tolerance), _HISTORY)
    )
