"""The scheduled drift check, for all aliased models at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.drift import (
    BASELINE,
    DriftPolicy,
    batch_statistics,
    feature_checks,
    flatten_features,
    merge_moments,
    moments,
    moments_batch,
    nest_profile,
    verdict,
)
from ..operators.feedback import recent_predictions
from ..runtime import SmallSide, null_safe_join, small_side

def run_drift_check(
    log: DataFrame,
    profiles: DataFrame,
    versions: DataFrame,
    as_of: Column,
    policy: DriftPolicy = DriftPolicy(),
) -> DataFrame:
    """(model_version, status, reason, checked_at, n_rows, features): one row per version.

    log:      predicted_at, prediction_id, model_version, features (JSON)
    profiles: model_version and the long profile
    versions: model_version, the versions to check (an alias resolved by the caller)

    A version without profile is SKIPPED, then one with too few predictions in the window;
    the rest is tested. The rows are read once after the window filter; everything after
    the aggregate is one row per version.
    """
    baselines = small_side(nest_profile(profiles, ["model_version"]).drop("n_rows"))
    wanted = small_side(versions.select("model_version").distinct())
    recent = recent_predictions(
        null_safe_join(log, wanted.df, ["model_version"], "left_semi"),
        as_of,
        policy.window_hours,
        policy.max_rows,
        keep=("features",),
    )
    features = profiled_features(baselines)
    batch = batch_statistics(
        flatten_features(recent, "features", features), features, ["model_version"]
    )
    joined = null_safe_join(
        null_safe_join(wanted.df, batch, ["model_version"], "left"),
        baselines.df,
        ["model_version"],
        "left",
    )
    return judge_batches(joined, policy).select(
        "model_version", "status", "reason", as_of.alias("checked_at"), "n_rows", "features"
    )


def day_summaries(log: DataFrame, features: list[str]) -> DataFrame:
    """(model_version, day, n_rows, moments) of the days of some logged rows.

    log: day, model_version, features (JSON). A daily job passes the rows of one day.
    """
    flat = flatten_features(log.select("model_version", "day", "features"), "features", features)
    return moments(flat, features, ["model_version", "day"])


def window_moments(
    log: DataFrame, summaries: DataFrame, begin: Column, end: Column, features: list[str]
) -> DataFrame:
    """(model_version, n_rows, moments) of the rows in [begin, end).

    log:       predicted_at, day, model_version, features (JSON); day is the date of the time
    summaries: model_version, day, n_rows, moments

    Days that lie in the window as a whole come from their summaries; only the rows of the two
    days at its edges are read. A day without a summary counts as a day without rows.
    """
    first = F.when(begin == F.date_trunc("day", begin), F.to_date(begin)).otherwise(
        F.date_add(F.to_date(begin), 1)
    )
    last = F.to_date(end)  # the day that is not whole any more
    within = (F.col("day") >= first) & (F.col("day") < last)
    whole = summaries.filter(within).select("model_version", "n_rows", "moments")
    edge = (F.col("day") == F.to_date(begin)) | (F.col("day") == last)
    rows = log.filter(
        edge & ~within & (F.col("predicted_at") >= begin) & (F.col("predicted_at") < end)
    )
    flat = flatten_features(rows.select("model_version", "features"), "features", features)
    parts = whole.unionByName(moments(flat, features, ["model_version"]))
    return merge_moments(parts.filter(F.col("model_version").isNotNull()), ["model_version"])


def run_summarized_check(
    log: DataFrame,
    summaries: DataFrame,
    profiles: DataFrame,
    versions: DataFrame,
    as_of: Column,
    policy: DriftPolicy = DriftPolicy(),
    end: Column | None = None,
) -> DataFrame:
    """``run_drift_check`` from day summaries: all rows from the window's begin on count.

    ``end`` bounds the rows, the end of the log's newest day by default. A policy of newest
    rows needs the rows themselves.
    """
    if policy.max_rows is not None:
        raise ValueError("summaries know no newest rows; use run_drift_check")
    baselines = small_side(nest_profile(profiles, ["model_version"]).drop("n_rows"))
    wanted = small_side(versions.select("model_version").distinct())
    features = profiled_features(baselines)
    begin = as_of - F.make_dt_interval(secs=F.lit(policy.window_hours * 3600.0).cast("decimal(18,6)"))
    if end is None:
        newest = summaries.agg(F.max("day")).first()[0]
        end = F.date_add(F.lit(newest).cast("date"), 1).cast(dict(log.dtypes)["predicted_at"])
    found = moments_batch(window_moments(log, summaries, begin, end, features))
    joined = null_safe_join(
        null_safe_join(wanted.df, found, ["model_version"], "left"),
        baselines.df,
        ["model_version"],
        "left",
    )
    return judge_batches(joined, policy).select(
        "model_version", "status", "reason", as_of.alias("checked_at"), "n_rows", "features"
    )


def profiled_features(baselines: SmallSide) -> list[str]:
    """The feature names of all profiles, sorted."""
    if baselines.is_small:
        lists = baselines.rows.column("baseline").to_pylist()
        return sorted({entry["feature"] for baseline in lists for entry in baseline})
    names = baselines.df.select(F.explode("baseline.feature").alias("feature")).distinct()
    return sorted(row.feature for row in names.collect())


def exit_code(report: DataFrame, policy: DriftPolicy = DriftPolicy()) -> int:
    """1 if a version is on ALERT and the policy says so, else 0."""
    alerts = report.filter(F.col("status") == "ALERT")
    return int(policy.fail_on_alert and not alerts.isEmpty())


def judge_batches(joined: DataFrame, policy: DriftPolicy) -> DataFrame:
    """Adds status, reason and features to rows of (model_version, n_rows, batch, baseline).

    Row-wise expressions only, so that it serves the batch job and the stream alike. A
    missing ``baseline`` means that the version has no profile, a missing ``n_rows`` that it
    had no traffic.
    """
    n_rows = F.coalesce("n_rows", F.lit(0).cast("long"))
    unknown = F.col("baseline").isNull()
    few = n_rows < policy.min_predictions
    # a skipped batch is compared with nothing, which gives no feature rows
    nothing = F.array().cast(BASELINE)
    compared = F.when(unknown | few, nothing).otherwise(F.col("baseline"))
    checks = F.coalesce(feature_checks(compared, "batch", policy.alpha), F.array())
    status, reason = verdict(F.col("features"), policy.alpha)
    no_profile = F.concat(F.lit("no profile is stored for version "), F.col("model_version"))
    too_few = F.concat(
        F.lit("too little traffic: "), n_rows.cast("string"), F.lit(f" of {policy.min_predictions}")
    )
    return (
        joined.withColumn("features", checks)
        .withColumn("status", F.when(unknown | few, "SKIPPED").otherwise(status))
        .withColumn(
            "reason", F.when(unknown, no_profile).when(few, too_few).otherwise(reason)
        )
        .withColumn("n_rows", F.when(unknown, 0).otherwise(n_rows).cast("long"))
        .drop("batch", "baseline")
    )
