"""Reference profiles and the per-feature z-test."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import critical_z, two_sided_p, z_score
from ..functions.values import to_double
from ..runtime import null_safe_join, small_side

# Fixed value: stands in for a standard deviation of exactly 0.
ZERO_STD = 1e-9


@dataclass(frozen=True)
class DriftPolicy:
    """Window, size and significance limits of a check."""

    # The defaults of the daily check.
    window_hours: float = 24
    min_predictions: int = 500
    # newest rows per version at most; by default all rows of the window count
    max_rows: int | None = None
    alpha: float = 0.05
    fail_on_alert: bool = True


BASELINE = "array<struct<feature:string,mean:double,std:double,missing_rate:double>>"
BATCH = "array<struct<feature:string,n:bigint,mean:double>>"

# -- profile --------------------------------------------------------------------------


def numeric_columns(df: DataFrame, columns: list[str]) -> list[str]:
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return [c for c in columns if c in numeric]


def reference_profile(
    df: DataFrame, columns: list[str], keys: list[str] | None = None
) -> DataFrame:
    """([keys], feature, mean, std, missing_rate, n_rows): one aggregate for all columns.

    Non-numeric columns and columns without a value are left out.
    """
    keys = keys or []
    entries = F.array(
        *[
            F.struct(
                F.lit(c),
                F.avg(to_double(c)),
                F.stddev_pop(to_double(c)),
                F.count(to_double(c)),
            )
            for c in numeric_columns(df, columns)
        ]
    ).cast("array<struct<feature:string,mean:double,std:double,n:bigint>>")
    wide = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), entries.alias("stats"))
    return (
        wide.select(*keys, "n_rows", F.inline("stats"))
        .filter("n > 0")
        .select(
            *keys,
            "feature",
            "mean",
            F.when(F.col("std") == 0, F.lit(ZERO_STD)).otherwise(F.col("std")).alias("std"),
            ((F.col("n_rows") - F.col("n")) / F.col("n_rows")).alias("missing_rate"),
            "n_rows",
        )
    )


def nest_profile(profile: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with ``baseline`` sorted by feature name."""
    return profile.groupBy(*keys).agg(
        F.max("n_rows").alias("n_rows"),
        F.sort_array(
            F.collect_list(F.struct("feature", "mean", "std", "missing_rate"))
        ).alias("baseline"),
    )


# -- logged inputs --------------------------------------------------------------------


def json_path(feature: str) -> str:
    return "$." + feature


def flatten_features(df: DataFrame, json_col: str, names: list[str]) -> DataFrame:
    """The named keys of a JSON column as doubles; a.b reads b inside of a.

    Unreadable values and broken JSON become null; booleans become 0 / 1 and numeric
    strings are parsed.
    """
    parsed = "__parsed"
    values = []
    for name in names:
        value = F.try_variant_get(parsed, json_path(name), "double")
        if "." in name:
            value = F.coalesce(value, F.try_variant_get(parsed, f'$["{name}"]', "double"))
        values.append(value.alias(name))
    kept = [F.col(c) for c in df.columns if c not in names]
    read = df.withColumn(parsed, F.try_parse_json(json_col)).select(*kept, *values)
    # a step of its own: the values are extracted once and then tested for NaN
    return read.withColumns({name: to_double(F.col(f"`{name}`")) for name in names})


# -- z-test ---------------------------------------------------------------------------


def batch_statistics(df: DataFrame, features: list[str], keys: list[str | Column]) -> DataFrame:
    """(keys, n_rows, batch): counts and means of all features in one aggregate."""
    entries = F.array(
        *[
            F.struct(
                F.lit(f), F.count(to_double(F.col(f"`{f}`"))), F.avg(to_double(F.col(f"`{f}`")))
            )
            for f in features
        ]
    ).cast(BATCH)
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), entries.alias("batch"))


# -- mergeable moments ----------------------------------------------------------------

MOMENTS = "array<struct<feature:string,n:bigint,mean:double,spread:double>>"


def moments(df: DataFrame, features: list[str], keys: list[str | Column]) -> DataFrame:
    """(keys, n_rows, moments): count, mean and sum of squared deviations of all features."""
    entries = []
    for f in features:
        value = to_double(F.col(f"`{f}`"))
        entries.append(
            F.struct(F.lit(f), F.count(value), F.avg(value), F.var_pop(value) * F.count(value))
        )
    entries = F.array(*entries).cast(MOMENTS)
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"), entries.alias("moments"))


def merge_moments(parts: DataFrame, keys: list[str]) -> DataFrame:
    """The moments of several groups of rows as those of all their rows.

    Sums of squared deviations are carried to the common mean, so nothing cancels as it would
    between plain sums of squares.
    """
    cells = parts.select(*keys, F.inline("moments")).filter("n > 0")
    common = cells.groupBy(*keys, "feature").agg(
        (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("common")
    )
    away = F.col("mean") - F.col("common")
    total = null_safe_join(cells, common, [*keys, "feature"], "inner").groupBy(*keys, "feature").agg(
        F.sum("n").alias("n"),
        F.first("common").alias("mean"),
        F.sum(F.col("spread") + F.col("n") * away * away).alias("spread"),
    )
    nested = total.groupBy(*keys).agg(
        F.sort_array(
            F.collect_list(F.struct("feature", "n", "mean", "spread"))
        ).alias("moments")
    )
    rows = parts.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"))
    joined = null_safe_join(rows, nested, keys, "left")
    return joined.select(*keys, "n_rows", F.coalesce("moments", F.array().cast(MOMENTS)).alias("moments"))


def moments_batch(merged: DataFrame) -> DataFrame:
    """Moments as the ``batch`` that feature checks compare."""
    batch = F.transform("moments", lambda m: F.struct(m["feature"], m["n"], m["mean"])).cast(BATCH)
    return merged.withColumn("batch", batch).drop("moments")


def moments_profile(merged: DataFrame, keys: list[str]) -> DataFrame:
    """Moments as a reference profile in long form."""
    std = F.sqrt(F.col("spread") / F.col("n"))
    return merged.select(*keys, "n_rows", F.inline("moments")).filter("n > 0").select(
        *keys,
        "feature",
        "mean",
        F.when(std == 0, F.lit(ZERO_STD)).otherwise(std).alias("std"),
        ((F.col("n_rows") - F.col("n")) / F.col("n_rows")).alias("missing_rate"),
        "n_rows",
    )


def feature_checks(baseline: str | Column, batch: str | Column, alpha: float) -> Column:
    """Array of checks in baseline order; features with fewer than two values are skipped."""
    stats = F.map_from_entries(
        F.transform(F.col(batch) if isinstance(batch, str) else batch,
                    lambda s: F.struct(s["feature"], s))
    )
    limit = critical_z(alpha)
    reference = F.col(baseline) if isinstance(baseline, str) else baseline

    def check(b: Column) -> Column:
        found = F.try_element_at(stats, b["feature"])
        mean, n = found["mean"], found["n"]
        z = z_score(mean, b["mean"], b["std"], n)
        return F.struct(
            b["feature"].alias("feature"),
            b["mean"].alias("reference_mean"),
            mean.alias("batch_mean"),
            z.alias("z_score"),
            two_sided_p(z).alias("p_value"),
            feature_status(z, limit).alias("status"),
        )

    comparable = F.filter(
        reference,
        lambda b: F.coalesce(F.try_element_at(stats, b["feature"])["n"] >= 2, F.lit(False)),
    )
    return F.transform(comparable, check)


def feature_status(z: Column, limit: float) -> Column:
    """ALERT if and only if the p-value is strictly below alpha, decided on |z|."""
    return F.when(F.abs(z) > F.lit(limit), "ALERT").otherwise("OK")


def alerted(checks: str | Column) -> Column:
    checks = F.col(checks) if isinstance(checks, str) else checks
    return F.transform(
        F.filter(checks, lambda c: c["status"] == "ALERT"), lambda c: c["feature"]
    )


def verdict(checks: Column, alpha: float) -> tuple[Column, Column]:
    """(status, reason) of an array of checks."""
    hits = alerted(checks)
    n_hits = F.size(hits)
    status = (
        F.when(F.size(checks) == 0, "SKIPPED").when(n_hits > 0, "ALERT").otherwise("OK")
    )
    reason = (
        F.when(F.size(checks) == 0, "profile and batch have no number in common")
        .when(n_hits > 0, F.concat(F.lit(f"p < {alpha} for "), F.array_join(hits, ", ")))
        .otherwise("all means agree with the profile")
    )
    return status, reason


def z_test(
    batch_stats: DataFrame, baselines: DataFrame, keys: list[str], alpha: float
) -> DataFrame:
    """(keys, feature, reference_mean, batch_mean, z_score, p_value, status)."""
    joined = null_safe_join(batch_stats, small_side(baselines.drop("n_rows")).df, keys, "inner")
    checks = joined.select(*keys, feature_checks("baseline", "batch", alpha).alias("checks"))
    return checks.select(*keys, F.inline("checks"))


def check_batch(
    batch_stats: DataFrame, baselines: DataFrame, keys: list[str], alpha: float = 0.05
) -> DataFrame:
    """(keys, status, reason, n_rows, features): one verdict per batch, no size gate."""
    joined = null_safe_join(batch_stats, small_side(baselines.drop("n_rows")).df, keys, "inner")
    checked = joined.withColumn("features", feature_checks("baseline", "batch", alpha))
    status, reason = verdict(F.col("features"), alpha)
    return checked.select(
        *keys, status.alias("status"), reason.alias("reason"), "n_rows", "features"
    )
