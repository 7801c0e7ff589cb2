from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.operators.drift import DriftPolicy
from driftline.operators.feedback import LABEL_SCHEMA
from driftline.sources import stores
from driftline.streaming import jobs

T0 = datetime(2024, 1, 1)


def log_rows(spark, *rows):
    """rows: id, hours after T0, value."""
    return spark.createDataFrame(
        [(i, T0 + timedelta(hours=h), "1", float(x)) for i, h, x in rows],
        "prediction_id string, predicted_at timestamp, model_version string, adr double",
    )


def run_stream(start):
    query = start()
    query.awaitTermination()
    return query


def test_log_survives_restarts_and_drops_repeats(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = log_rows(spark, ("a", 1, 1), ("b", 2, 2), ("a", 1, 1))
    first.write.mode("append").parquet(source)

    def start():
        stream = jobs.file_stream(spark, source, first.schema)
        return jobs.stream_prediction_log(stream, sink, state, watermark="6 hours")

    query = run_stream(start)
    counters = jobs.sink_counters(query).agg(F.sum("rows_in"), F.sum("rows_duplicate")).first()
    assert tuple(counters) == (3, 1)
    log_rows(spark, ("b", 2, 2), ("c", 3, 3)).write.mode("append").parquet(source)
    run_stream(start)
    run_stream(start)
    got = sorted(r.prediction_id for r in spark.read.parquet(sink).collect())
    assert got == ["a", "b", "c"]


def test_log_keeps_first_time_ids_that_arrive_late(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def send(*rows):
        df = log_rows(spark, *rows).withColumn("price", F.expr("struct(CAST(adr AS decimal(9,2)) AS eur)"))
        df.write.mode("append").parquet(source)
        return run_stream(lambda: jobs.stream_prediction_log(
            jobs.file_stream(spark, source, df.schema), sink, state, watermark="1 hour"))

    send(("a", 48, 1))
    send(("b", 49, 1))
    query = send(("late", 1, 1), ("late", 1, 1), ("b", 2, 1), (None, 50, 1), (None, 50, 1))
    got = [r.prediction_id for r in spark.read.parquet(sink).collect()]
    assert sorted(map(str, got)) == ["None", "a", "b", "late"]
    counters = {r.batch_id: tuple(r)[1:] for r in jobs.sink_counters(query).collect()}
    assert counters == {0: (1, 0, 0, 1), 1: (1, 0, 0, 2), 2: (5, 3, 3, 4)}


def test_counters_outlast_the_progress_that_spark_keeps(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for i in range(5):
        rows = log_rows(spark, (f"p{i}", i, 1), (f"p{i}", i, 1)).coalesce(1)
        rows.write.mode("append").parquet(source)
    name = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(name)
    spark.conf.set(name, 2)
    try:
        query = run_stream(lambda: jobs.stream_prediction_log(
            jobs.file_stream(spark, source, rows.schema, files_per_trigger=1), sink, state))
        totals = jobs.sink_counters(query).agg(
            F.count("*"), F.sum("rows_in"), F.sum("rows_duplicate")).first()
    finally:
        spark.conf.set(name, before)
    assert tuple(totals) == (5, 10, 5)


def test_log_store_ignores_ids_of_any_age(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    log = stores.PredictionLog(spark, str(tmp_path / "log"))

    def rows(*ids):
        return spark.createDataFrame(
            [(i, T0, "m", "s", "1", "a", 0.5, 0.1, "{}") for i in ids], stores.PREDICTION_SCHEMA
        )

    for batch in (("a", "b"), ("b", "c"), ("a",)):
        rows(*batch).write.mode("append").parquet(source)
        run_stream(lambda: jobs.stream_log_to_store(
            jobs.file_stream(spark, source, rows("x").schema), log, state))
    assert sorted(r.prediction_id for r in log.read().collect()) == ["a", "b", "c"]


def test_labels_wait_for_their_prediction(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    store = stores.LabelStore(spark, str(tmp_path / "labels"))
    known = ["a"]

    def send(*rows):
        spark.createDataFrame(
            [(i, s, T0 + timedelta(hours=h), "job") for i, s, h in rows], LABEL_SCHEMA
        ).write.mode("append").parquet(source)
        schema = spark.createDataFrame([], LABEL_SCHEMA).schema
        run_stream(lambda: jobs.stream_label_reconcile(
            jobs.file_stream(spark, source, schema),
            lambda: spark.createDataFrame([(i,) for i in known], "prediction_id string"),
            store, str(tmp_path / "pending"), state,
        ))
        return {(r.prediction_id, r.actual_segment) for r in store.current().collect()}

    assert send(("a", "x", 1), ("late", "y", 1), ("never", "n", 1)) == {("a", "x")}
    assert send(("a", "z", 2)) == {("a", "z")}
    known.append("late")
    assert send(("a", "w", 3)) == {("a", "w"), ("late", "y")}
    # a batch that runs twice changes nothing
    pending = stores.BatchTable(spark, str(tmp_path / "pending"), LABEL_SCHEMA)
    predictions = spark.createDataFrame([(i,) for i in known], "prediction_id string")
    again = spark.createDataFrame([("a", "w", T0 + timedelta(hours=3), "job")], LABEL_SCHEMA)
    jobs.reconcile_batch(predictions, store, pending, again, 2)
    assert {(r.prediction_id, r.actual_segment) for r in store.current().collect()} == {
        ("a", "w"), ("late", "y")}


@pytest.mark.parametrize("slide", [None, "12 hours"])
def test_drift_windows_equal_the_batch(spark, tmp_path, slide):
    source = str(tmp_path / "in")
    rows = [(f"p{i}", i * 0.5, 100 + (i % 7) + (60 if 48 <= i < 96 else 0)) for i in range(200)]
    log = log_rows(spark, *rows)
    log.write.parquet(source)
    profiles = spark.createDataFrame([("1", "adr", 103.0, 2.0, 0.0, 9)], stores.PROFILE_SCHEMA)
    policy = DriftPolicy(window_hours=24, min_predictions=10, alpha=0.001)
    stream = jobs.file_stream(spark, source, log.schema)
    report = jobs.drift_windows(stream, profiles, ["adr"], policy, "2 hours", slide)
    sink = str(tmp_path / "out")
    run_stream(lambda: jobs.stream_drift_windows(report, sink, str(tmp_path / "state")))
    got = {r.window.start: (r.n_rows, r.status) for r in spark.read.parquet(sink).collect()}
    closed = T0 + timedelta(hours=199 * 0.5 - 2)
    batch = jobs.drift_windows(log, profiles, ["adr"], policy, "2 hours", slide).collect()
    want = {r.window.start: (r.n_rows, r.status) for r in batch if r.window.end <= closed}
    assert got == want
    assert got[T0] == (48, "OK") and got[T0 + timedelta(days=1)] == (48, "ALERT")
