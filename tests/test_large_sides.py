"""The same results when a side is too large to be broadcast."""

import pytest
from pyspark.sql import functions as F

from driftline import runtime
from driftline.operators import aggregates, cleaning, drift, features, ranking, sampling
from driftline.plans import drift_job
from driftline.sources import stores


@pytest.fixture
def tiny_limit(monkeypatch):
    def limited(df):
        return runtime.small_side(df, max_rows=1)

    for module in (aggregates, cleaning, drift, drift_job, features, ranking):
        if hasattr(module, "small_side"):
            monkeypatch.setattr(module, "small_side", limited)


def test_splits_and_samples(spark, request):
    df = spark.range(3000).select("id", (F.col("id") % 3 + F.col("id") % 2).cast("string").alias("c"))
    def results():
        split = sampling.stratified_split(df, "c", "id", 1)
        quota = sampling.stratified_quota_sample(df, "c", "id", 100, 10, 1)
        rare = cleaning.drop_rare_classes(df, "c", 600)
        weights = features.balanced_weights(df, "c").select("id", F.round("weight", 9))
        vocabulary = features.category_vocabulary(df, ["c", "id"], 600)
        tables = (split, quota, rare, weights, vocabulary)
        return [{tuple(r) for r in x.collect()} for x in tables]

    plain = results()
    request.getfixturevalue("tiny_limit")
    assert results() == plain


def test_many_groups_descend(spark, tiny_limit):
    df = spark.range(2000).select("id", (F.col("id") % 50).alias("g"))
    digits = [F.col("id") % 7, F.col("id") % 11, F.col("id")]
    cuts = ranking.rank_cuts(df, ["g"], digits, {"cut": F.lit(4)}, task_rows=1)
    assert not cuts.is_small
    kept = ranking.with_cuts(df, ["g"], cuts).filter(ranking.order_value(digits) <= F.col("cut"))
    got = {}
    for r in kept.collect():
        got.setdefault(r.g, set()).add(r.id)
    for g in range(50):
        ids = sorted(range(g, 2000, 50), key=lambda i: (i % 7, i % 11, i))
        assert got[g] == set(ids[:4])


def test_drift_check(spark, request):
    log = spark.range(60).select(
        F.col("id").cast("string").alias("prediction_id"),
        F.lit("2024-01-09 12:00:00").cast("timestamp_ntz").alias("predicted_at"),
        (F.col("id") % 3).cast("string").alias("model_version"),
        F.concat(F.lit('{"x": '), F.col("id"), F.lit("}")).alias("features"),
    )
    profiles = spark.createDataFrame(
        [("0", "x", 29.0, 17.0, 0.0, 9), ("1", "x", 90.0, 1.0, 0.0, 9), ("2", "y", 1.0, 1.0, 0.0, 9)],
        stores.PROFILE_SCHEMA,
    )
    versions = log.select("model_version")
    as_of = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    policy = drift.DriftPolicy(min_predictions=10, max_rows=15)

    def results():
        report = drift_job.run_drift_check(log, profiles, versions, as_of, policy)
        return {(r.model_version, r.status, r.n_rows, r.reason) for r in report.collect()}

    plain = results()
    assert {(v, s, n) for v, s, n, _ in plain} == {("0", "OK", 15), ("1", "ALERT", 15), ("2", "SKIPPED", 15)}
    request.getfixturevalue("tiny_limit")
    assert results() == plain
