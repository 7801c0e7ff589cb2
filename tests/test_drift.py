import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.functions.stats import critical_z, two_sided_p
from driftline.operators import drift, feedback, lineage
from driftline.plans.drift_job import exit_code, run_drift_check
from driftline.sources import stores


def normals(spark, n, adr_mean, seed, adr_std=30):
    rng = random.Random(seed)
    rows = [(rng.gauss(100, 20), rng.gauss(adr_mean, adr_std), "ab"[i % 2]) for i in range(n)]
    return spark.createDataFrame(rows, "lead_time double, adr double, hotel string")


@pytest.fixture(scope="module")
def reference(spark):
    df = normals(spark, 5000, 100, 1)
    return drift.reference_profile(df, df.columns)


def check(batch, profile, alpha=0.05):
    names = [r.feature for r in profile.select("feature").collect()]
    keyed = batch.withColumn("v", F.lit("1"))
    known = [n for n in names if n in batch.columns]
    stats = drift.batch_statistics(keyed, known, ["v"])
    base = drift.nest_profile(profile.withColumn("v", F.lit("1")), ["v"])
    return drift.check_batch(stats, base, ["v"], alpha).first()


def test_profile_is_numeric_only(reference):
    rows = {r.feature: r for r in reference.collect()}
    assert set(rows) == {"lead_time", "adr"}
    assert rows["adr"].n_rows == 5000 and rows["adr"].std == pytest.approx(30, rel=0.05)


def test_profile_missing_constant_empty(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1.0, 5.0, None), (3.0, 5.0, None), (nan, 5.0, None), (None, 5.0, None)],
        "x double, c double, e double",
    )
    rows = {r.feature: r for r in drift.reference_profile(df, ["x", "c", "e"]).collect()}
    assert set(rows) == {"x", "c"}
    assert (rows["x"].mean, rows["x"].std, rows["x"].missing_rate) == (2.0, 1.0, 0.5)
    assert rows["c"].std == 1e-9


def test_same_and_shifted(spark, reference):
    same = check(normals(spark, 500, 100, 2), reference, alpha=0.001)
    assert same.status == "OK" and len(same.features) == 2
    shifted = check(normals(spark, 500, 250, 3), reference, alpha=0.001)
    assert shifted.status == "ALERT"
    assert {f.feature: f.status for f in shifted.features} == {"adr": "ALERT", "lead_time": "OK"}
    assert shifted.reason == "p < 0.001 for adr"
    found = next(f for f in shifted.features if f.feature == "adr")
    mean = normals(spark, 500, 250, 3).agg(F.avg("adr")).first()[0]
    base = reference.filter("feature = 'adr'").first()
    assert found.z_score == pytest.approx((mean - base.mean) / (base.std / math.sqrt(500)))


def test_nothing_comparable(spark, reference):
    other = check(spark.createDataFrame([(1,), (2,), (3,)], "unrelated long"), reference)
    assert other.status == "SKIPPED" and other.features == [] and other.n_rows == 3
    single = check(spark.createDataFrame([(100.0,)], "adr double"), reference)
    assert single.status == "SKIPPED"


def test_p_value(spark):
    zs = [i / 10 for i in range(0, 300)]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, p in df.select("z", two_sided_p("z")).collect():
        assert p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=2e-7)
        assert p <= 1.0
    assert critical_z(0.05) == pytest.approx(1.959963985)
    assert critical_z(0.0) == math.inf and critical_z(2) < 0


def test_flatten(spark):
    rows = [
        ('{"a": 1, "b": {"c": "2.5"}}',), ('{"a": true, "b.c": 4}',), ('{"a": "x", "b": 3}',),
        ("broken",), (None,), ('{"a": "NaN", "b": {"c": null}}',),
    ]
    df = spark.createDataFrame(rows, "features string")
    got = [tuple(r)[1:] for r in drift.flatten_features(df, "features", ["a", "b.c"]).collect()]
    assert got == [(1.0, 2.5), (1.0, 4.0), (None, None), (None, None), (None, None), (None, None)]


def log_rows(spark, specs):
    """specs: (version, hours ago, value) with as_of = 2024-01-10."""
    start = datetime(2024, 1, 10)
    rows = [
        (f"p{i}", start - timedelta(hours=h), v, json.dumps({"adr": x}))
        for i, (v, h, x) in enumerate(specs)
    ]
    return spark.createDataFrame(
        rows, "prediction_id string, predicted_at timestamp_ntz, model_version string, features string"
    )


@pytest.fixture(scope="module")
def as_of(spark):
    return F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")


def test_recent_predictions_newest_first(spark, as_of):
    specs = [("1", h, float(h)) for h in range(40)] + [("2", 1, 1.0)] * 5 + [(None, 1, 0.0)]
    log = log_rows(spark, specs)
    got = feedback.recent_predictions(log, as_of, 24, 10, keep=("prediction_id",))
    by_version = {}
    for r in got.collect():
        by_version.setdefault(r.model_version, set()).add(r.prediction_id)
    assert by_version["1"] == {f"p{i}" for i in range(10)}
    assert len(by_version["2"]) == 5 and None not in by_version
    whole = feedback.recent_predictions(log, as_of, 24, 100, "1", keep=("prediction_id",))
    assert whole.count() == 25  # both ends of the window count
    zoned = log.withColumn("predicted_at", F.col("predicted_at").cast("timestamp"))
    same = feedback.recent_predictions(zoned, as_of.cast("timestamp"), 24, 10, keep=("prediction_id",))
    assert {r.prediction_id for r in same.collect()} == by_version["1"] | by_version["2"]


def test_recent_predictions_within_one_instant(spark, as_of):
    log = log_rows(spark, [("1", 1, float(i)) for i in range(200)])
    got = feedback.recent_predictions(log, as_of, 24, 50, keep=("prediction_id",)).collect()
    import hashlib

    ids = sorted((f"p{i}" for i in range(200)), key=lambda p: hashlib.md5(f"0:{p}".encode()).hexdigest())
    assert {r.prediction_id for r in got} == set(ids[:50])


def test_window_filter_reaches_the_scan(spark, as_of, tmp_path):
    path = str(tmp_path / "log")
    log_rows(spark, [("1", h, 1.0) for h in range(40)]).write.parquet(path)
    recent = feedback.recent_predictions(spark.read.parquet(path), as_of, 24, 100)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(predicted_at" in plan


def test_run_check_order_of_skips(spark, as_of):
    specs = [("few", 1, 100.0)] * 9 + [("ok", 1, 99.0), ("ok", 2, 101.0)] * 5
    specs += [("far", 1, 300.0)] * 10 + [("bare", 1, 1.0)] * 10 + [("old", 60, 1.0)] * 20
    profiles = spark.createDataFrame(
        [(v, "adr", 100.0, 10.0, 0.0, 50) for v in ("few", "ok", "far", "old")],
        stores.PROFILE_SCHEMA,
    )
    versions = spark.createDataFrame([(v,) for v in ("few", "ok", "far", "bare", "old")],
                                     "model_version string")
    policy = drift.DriftPolicy(min_predictions=10)
    report = run_drift_check(log_rows(spark, specs), profiles, versions, as_of, policy)
    rows = {r.model_version: r for r in report.collect()}
    assert rows["few"].status == "SKIPPED" and rows["few"].n_rows == 9
    assert rows["few"].reason == "too little traffic: 9 of 10"
    assert rows["old"].reason == "too little traffic: 0 of 10"
    assert rows["bare"].n_rows == 0 and "no profile" in rows["bare"].reason
    assert rows["ok"].status == "OK" and rows["far"].status == "ALERT"
    assert rows["far"].features[0].z_score == pytest.approx(200 / (10 / math.sqrt(10)))
    assert exit_code(report, policy) == 1
    assert exit_code(report.filter("status <> 'ALERT'"), policy) == 0
    assert exit_code(report, drift.DriftPolicy(fail_on_alert=False)) == 0
    facts = {(r.key, r.value) for r in
             lineage.check_facts(report.filter("model_version = 'few'"), "c1").collect()}
    assert facts == {("drift_status", "SKIPPED"), ("n_rows", "9"),
                     ("n_features_checked", "0"), ("n_features_alerted", "0")}


def test_profile_json_round_trip(spark, reference):
    performance = {"f1_weighted": 0.8, "accuracy": 0.7, "n_eval": 10}
    text = stores.profile_json(reference, "2024-01-01T00:00:00+00:00", performance)
    document = json.loads(text.first().profile)
    assert list(document) == sorted(document) and list(document["numeric"]) == ["adr", "lead_time"]
    assert document["performance"] == performance
    back = {r.feature: tuple(r)[0:5] for r in stores.parse_profile_json(text).collect()}
    want = {r.feature: (r.feature, r.mean, r.std, r.missing_rate, r.n_rows) for r in reference.collect()}
    assert {k: (v[1], *v[2:], ) for k, v in want.items()}.keys() == back.keys()
    assert json.loads(stores.profile_json(reference, "x").first().profile)["performance"] is None


def test_profile_store(spark, reference, tmp_path):
    store = stores.ProfileStore(spark, str(tmp_path / "profiles"))
    assert store.read_profile("3").count() == 0
    store.write_profile(reference, "3")
    store.write_profile(reference, "3")
    assert store.read_profile("3").count() == 2
    assert store.read_profile("4").count() == 0
