"""Sizes and gaps that must not change what a job answers."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from driftline import runtime
from driftline.operators import drift, features, lineage, modeling, promotion
from driftline.plans.queries_log import event_log
from driftline.sources.bookings import read_csv_text


def test_long_properties_stay_whole(spark, tmp_path):
    props = '{"k": "' + "x" * 20_000 + '", "amount": 5}'
    rows = [(1, datetime(2024, 1, 1), "click", 2.0, props)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet")
    )
    log = event_log(spark, str(tmp_path))
    assert drift.flatten_features(log, "features", ["amount"]).first()["amount"] == 5.0


def test_more_than_a_hundred_classes(spark):
    classes = [f"c{i:03d}" for i in range(150)]
    df = spark.createDataFrame([(c, float(i)) for i, c in enumerate(classes)], "label string, x double")
    inputs = features.ModelInputs.of(number=("x",))
    rows = modeling.training_rows(df, features.fit_preprocessor(df, inputs), "label", classes)
    model = modeling.fit_classifier(rows, modeling.ForestParams(n_estimators=1, max_depth=2), 1)
    assert model.numClasses == 150
    assert model.predict(Vectors.dense(3.0)) < 150


def test_depths_beyond_the_forest_are_refused_or_one_trial(spark):
    trials = modeling.draw_trials(10_000, 1)
    assert len(trials) == len(set(trials)) and trials[0] == modeling.ForestParams()
    assert {t.max_depth for t in trials} == {None, 20}
    with pytest.raises(ValueError):
        modeling.fit_classifier(None, modeling.ForestParams(max_depth=31), 1)


def test_shared_folder_is_asked_for_on_a_cluster():
    class Context:
        master, applicationId = "spark://somewhere:7077", "a"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        runtime.shared_dir(Session)
    Context.master = "local[2]"
    assert runtime.shared_dir(Session) == runtime.shared_dir(Session)


def test_wide_small_side_is_not_broadcast(spark, monkeypatch):
    df = spark.range(3).withColumn("text", F.repeat(F.lit("x"), 1000))
    assert runtime.small_side(df).is_small
    monkeypatch.setattr(runtime, "SMALL_SIDE_BYTES", 100)
    assert not runtime.small_side(df).is_small


def test_fingerprint_keeps_neighbours_and_nulls_apart(spark):
    def of(*row):
        df = spark.createDataFrame([row], "a string, b string")
        return lineage.dataset_fingerprint(df, ["a", "b"]).first()["hash_sum"]

    found = [of("a|b", "c"), of("a", "b|c"), of(None, "c"), of("\\N", "c"), of("-", "c"), of("", "c")]
    assert len(set(found)) == len(found)


def test_csv_keeps_texts_as_they_are(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n"BB ","say ""hi""\nthere"\n NA ,z\n')
    rows = {tuple(r) for r in read_csv_text(spark, str(tmp_path / "a.csv")).collect()}
    assert rows == {("BB ", 'say "hi"\nthere'), (None, "z")}


@pytest.mark.parametrize("range_runs", [1, 2, 100])
def test_missing_scores_leave_the_champion(spark, range_runs, monkeypatch):
    monkeypatch.setattr(promotion, "MIN_RANGE_RUNS", 1)
    scores = [None, 0.7, None, 0.5, float("nan"), 0.9]
    rows = [("m", i, str(i), s, "passed") for i, s in enumerate(scores)]
    runs = spark.createDataFrame(rows, "model string, run_order long, version string, f1 double, quality_gate string")
    history = promotion.replay_promotions(runs, range_runs=range_runs).orderBy("run_order").collect()
    assert [r.verdict for r in history] == [
        "error_profile", "bootstrap", "error_profile", "rejected", "error_profile", "accepted"
    ]
    assert [r.champion_version for r in history] == [None, None, "1", "1", "1", "1"]


def _verdicts(spark, versions):
    candidates = spark.createDataFrame([("r", "m", "live")], "run_id string, model string, alias string")
    runs = spark.createDataFrame([("r", "passed")], "run_id string, quality_gate string")
    table = spark.createDataFrame(versions, "model string, version string, run_id string, promoted_from_version string")
    aliases = spark.createDataFrame([], "model string, alias string, version string")
    profiles = spark.createDataFrame([("r", 0.5)], "run_id string, f1_weighted double")
    return promotion.promotion_verdict(candidates, runs, table, aliases, profiles), table, aliases


@pytest.mark.parametrize("names", [[], ["1", "2"]])
def test_candidate_needs_exactly_one_version(spark, names):
    verdicts, table, aliases = _verdicts(spark, [("m", n, "r", None) for n in names])
    assert [r.verdict for r in verdicts.collect()] == ["error_candidate"]
    assert promotion.apply_promotion(verdicts, table, aliases)[1].count() == 0


def test_one_version_under_two_aliases_stays_one_row(spark):
    _, table, aliases = _verdicts(spark, [("m", "1", "r", None)])
    moves = [("m", alias, "1", "0", "accepted") for alias in ("a", "b")]
    kind = "model string, alias string, version string, champion_version string, verdict string"
    tagged, pointed = promotion.apply_promotion(spark.createDataFrame(moves, kind), table, aliases)
    assert tagged.count() == 1 and pointed.count() == 2
    twice = spark.createDataFrame([moves[0], ("m", "a", "2", "0", "accepted")], kind)
    with pytest.raises(PySparkException):
        promotion.apply_promotion(twice, table, aliases)[1].collect()
