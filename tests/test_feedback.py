from datetime import datetime

import pytest
from pyspark.sql import functions as F

from driftline.operators import feedback, lineage
from driftline.sources import stores

T0 = datetime(2024, 1, 1)


def at(hour):
    return datetime(2024, 1, 1, hour)


def predictions(spark, *ids):
    rows = [(i, T0, "m", "staging", "1", "a", 0.7, 0.5, "{}") for i in ids]
    return spark.createDataFrame(rows, stores.PREDICTION_SCHEMA)


def labels(spark, *rows):
    return spark.createDataFrame([(i, s, at(h), "job") for i, s, h in rows], feedback.LABEL_SCHEMA)


def test_first_of_a_batch_wins_and_known_ids_are_ignored(spark):
    log = spark.createDataFrame([("a", at(1), 1)], "prediction_id string, predicted_at timestamp, x int")
    batch = spark.createDataFrame(
        [("a", at(0), 9), ("b", at(3), 3), ("b", at(2), 2), ("c", at(1), 5), ("c", at(1), 4)],
        log.schema,
    )
    got = {(r.prediction_id, r.x) for r in feedback.append_predictions(log, batch).collect()}
    assert got == {("a", 1), ("b", 2), ("c", 4)}


def test_upsert(spark):
    known = predictions(spark, "a", "b", "c")
    stored = labels(spark, ("a", "old", 5), ("b", "kept", 5))
    batch = labels(spark, ("a", "new", 1), ("c", "x", 1), ("c", "y", 2), ("zz", "q", 1))
    got = feedback.upsert_labels(known, stored, batch)
    rows = {r.prediction_id: r.actual_segment for r in got.labels.collect()}
    assert rows == {"a": "new", "b": "kept", "c": "y"}
    assert tuple(got.counts.first()) == (3, 1)
    assert [r.prediction_id for r in got.unmatched.collect()] == ["zz"]
    again = feedback.upsert_labels(known, got.labels, batch)
    assert {tuple(r) for r in again.labels.collect()} == {tuple(r) for r in got.labels.collect()}
    empty = feedback.upsert_labels(known, stored, batch.limit(0))
    assert tuple(empty.counts.first()) == (0, 0) and empty.labels.count() == 2


def test_purge_cascades(spark):
    kept, left = feedback.purge_predictions(
        predictions(spark, "a", "b"), labels(spark, ("a", "x", 1), ("b", "y", 1)),
        F.col("prediction_id") == "a",
    )
    assert [r.prediction_id for r in kept.collect()] == ["b"]
    assert [r.prediction_id for r in left.collect()] == ["b"]


def test_labelled_accuracy(spark):
    known = predictions(spark, "a", "b", "c", "d")
    got = feedback.labelled_accuracy(
        known, labels(spark, ("a", "a", 1), ("b", "a", 1), ("c", "z", 1)), ["model_version"]
    ).first()
    assert got.n == 3 and got.accuracy == pytest.approx(2 / 3)
    assert got.f1_macro == pytest.approx(0.4)


def test_log_store_repeats_change_nothing(spark, tmp_path):
    log = stores.PredictionLog(spark, str(tmp_path / "log"))
    assert log.read().count() == 0
    for _ in range(2):
        log.append(predictions(spark, "a", "b"), "000")
    log.append(predictions(spark, "b", "c"), "001")
    log.append(predictions(spark, "c"), "002")
    assert sorted(r.prediction_id for r in log.read().collect()) == ["a", "b", "c"]
    recent = log.read().filter("predicted_date = '2024-01-01'")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(predicted_date" in plan


def test_label_store_keeps_the_newest_batch(spark, tmp_path):
    known = predictions(spark, "a", "b")
    store = stores.LabelStore(spark, str(tmp_path / "labels"))
    left = store.upsert(known, labels(spark, ("a", "x", 9), ("zz", "q", 1)), "000")
    assert [r.prediction_id for r in left.collect()] == ["zz"]
    for _ in range(2):
        store.upsert(known, labels(spark, ("a", "y", 1), ("b", "z", 1)), "001")
    want = {("a", "y"), ("b", "z")}
    assert {(r.prediction_id, r.actual_segment) for r in store.current().collect()} == want
    small = store.compact(str(tmp_path / "compacted"), "002")
    assert small.read().count() == 2
    assert {(r.prediction_id, r.actual_segment) for r in small.current().collect()} == want


def test_runs_and_tags(spark, tmp_path):
    runs = stores.RunStore(spark, str(tmp_path / "runs"))
    facts = lineage.run_facts(spark, "r1", {"depth": None, "trees": 3}, {"f1": 0.5}, {"gate": "passed"})
    facts = facts.unionByName(lineage.run_tags(spark, "r1", commit="abc", used_toy_data="False"))
    runs.log(facts, "r1")
    runs.log(facts, "r1")
    got = {(r.kind, r.key): r.value for r in runs.read().collect()}
    assert got["param", "depth"] is None and got["metric", "f1"] == "0.5"
    assert got["tag", "git_commit_hash"] == "abc" and got["tag", "container_image_tag"] == "local-dev"
    assert len(got) == 8 == runs.read().count()


def test_fingerprint_ignores_order_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, s string")
    one = lineage.dataset_fingerprint(df, ["x", "s"]).first()
    assert one == lineage.dataset_fingerprint(df.orderBy(F.desc("x")).repartition(3), ["x", "s"]).first()
    changed = df.withColumn("s", F.coalesce("s", F.lit("")))
    assert one != lineage.dataset_fingerprint(changed, ["x", "s"]).first()


def test_a_batch_written_again_replaces_its_whole_folder(spark, tmp_path):
    pending = stores.BatchTable(spark, str(tmp_path / "pending"), feedback.LABEL_SCHEMA)
    pending.write(labels(spark, ("a", "x", 1)), "b:1")
    pending.write(labels(spark, ("b", "y", 1)), "b:2")
    pending.write(labels(spark), "b:1")
    assert [(r.prediction_id, r.batch) for r in pending.read().collect()] == [("b", "b:2")]


def test_a_batch_written_again_leaves_no_rows_of_other_days(spark, tmp_path):
    log = stores.PredictionLog(spark, str(tmp_path / "log"))
    log.append(predictions(spark, "a", "b"), "1")
    later = predictions(spark, "a").withColumn("predicted_at", F.expr("predicted_at + interval 3 days"))
    log.append(later, "1")
    assert [(r.prediction_id, str(r.predicted_date)) for r in log.read().collect()] == [
        ("a", "2024-01-04")
    ]
