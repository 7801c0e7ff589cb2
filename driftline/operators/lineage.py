"""Run facts in long form and an order-insensitive table fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_FACT = "array<struct<kind:string,key:string,value:string>>"


def run_facts(
    spark: SparkSession,
    run_id: str,
    params: dict | None = None,
    metrics: dict | None = None,
    tags: dict | None = None,
) -> DataFrame:
    """(run_id, kind, key, value) of one run's driver-side facts."""
    rows = [
        (run_id, kind, key, None if value is None else str(value))
        for kind, facts in (("param", params), ("metric", metrics), ("tag", tags))
        for key, value in (facts or {}).items()
    ]
    return spark.createDataFrame(rows, "run_id string, kind string, key string, value string")


def run_tags(
    spark: SparkSession,
    run_id: str,
    commit: str = "unknown",
    data_hash: str = "unknown",
    image_tag: str = "local-dev",
    **more: str,
) -> DataFrame:
    """The lineage tags every run carries; the caller knows their values."""
    tags = {
        "git_commit_hash": commit,
        "data_hash": data_hash,
        "container_image_tag": image_tag,
        **more,
    }
    return run_facts(spark, run_id, tags=tags)


def metric_rows(df: DataFrame, name_columns: list[str], metrics: list[str]) -> DataFrame:
    """(key, value) of every metric of every row; key = metric and the row's names."""
    entries = F.array(
        *[
            F.struct(
                F.concat_ws("/", F.lit(metric), *[F.col(c) for c in name_columns]).alias("key"),
                F.col(metric).cast("double").alias("value"),
            )
            for metric in metrics
        ]
    )
    return df.select(F.inline(entries))


def check_facts(report: DataFrame, run_id: str | Column) -> DataFrame:
    """(run_id, kind, key, value) of drift verdicts: status tag, counts, z per feature."""
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    checks = F.coalesce("features", F.array())
    n_alerts = F.size(F.filter("features", lambda c: c["status"] == "ALERT"))

    def fact(kind: str, key: Column, value: Column) -> Column:
        return F.struct(F.lit(kind), key, value.cast("string"))

    fixed = F.array(
        fact("tag", F.lit("drift_status"), F.col("status")),
        fact("metric", F.lit("n_rows"), F.col("n_rows")),
        fact("metric", F.lit("n_features_checked"), F.size(checks)),
        fact("metric", F.lit("n_features_alerted"), F.coalesce(n_alerts, F.lit(0))),
    ).cast(_FACT)
    scores = F.transform(
        checks, lambda c: fact("metric", F.concat(F.lit("z_"), c["feature"]), c["z_score"])
    ).cast(_FACT)
    return report.select(run.alias("run_id"), F.inline(F.concat(fixed, scores)))


def dataset_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """(n_rows, hash_sum, hash_xor): equal for equal rows in any order or partitioning."""
    values = [F.col(c).cast("string") for c in columns]
    # lengths keep neighbouring texts apart, a sign without one stands for null
    texts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    row = F.conv(F.substring(F.md5(F.concat(*texts)), 1, 8), 16, 10).cast("long")
    return df.agg(
        F.count("*").alias("n_rows"),
        # 64-bit sums of 32-bit hashes wrap after 2^31 rows; decimals do not
        F.sum(row.cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor(row).alias("hash_xor"),
    )
