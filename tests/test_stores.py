"""Bucketed logs, tombstones, compaction, day summaries and amendable windows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.operators import drift
from driftline.operators.drift import DriftPolicy
from driftline.plans import drift_job
from driftline.runtime import Staging
from driftline.sources import stores
from driftline.streaming import jobs

T0 = datetime(2024, 1, 1)


def logged(spark, *ids, hours=0, version="1"):
    return spark.createDataFrame(
        [(i, T0 + timedelta(hours=hours), "m", "s", version, "a", 0.5, 0.1, '{"adr": 5}') for i in ids],
        stores.PREDICTION_SCHEMA,
    )


def labelled(spark, *rows):
    return spark.createDataFrame(
        [(i, s, T0 + timedelta(hours=h), "job") for i, s, h in rows], stores.LABEL_SCHEMA
    )


def ids_of(df):
    return sorted(r.prediction_id for r in df.collect())


def test_a_small_batch_reads_only_the_buckets_of_its_ids(spark, tmp_path):
    log = stores.PredictionLog(spark, str(tmp_path / "log"), buckets=16)
    rows = spark.range(4_000).select(
        F.concat(F.lit("p"), "id").alias("prediction_id"),
        F.lit(T0).cast("timestamp").alias("predicted_at"),
        *[F.lit("x").alias(c) for c in ("model_name", "model_alias", "model_version", "predicted_segment")],
        *[F.lit(0.5).alias(c) for c in ("confidence", "margin")],
        F.lit("{}").alias("features"),
        F.lit("2024-01-01").cast("date").alias("predicted_date"),
        F.format_string("%06d", F.col("id") % 1_000).alias("batch"),
    )
    rows = rows.withColumn("id_bucket", log.bucket())
    # a thousand batches written at once, in the folders that a thousand appends would have made
    rows.repartition(4, "batch").write.partitionBy("batch", "predicted_date", "id_bucket").option(
        "parquet.bloom.filter.enabled#prediction_id", "true"
    ).parquet(log.path)
    files = log.read().select(F.input_file_name()).distinct().count()
    with Staging(spark) as staging:
        few = staging.put(spark.createDataFrame([("p17",), ("new",)], "prediction_id string"), "ids")
        held = log.holding(few)
        assert ids_of(held) == ["p17"]
        plan = held._jdf.queryExecution().executedPlan().toString()
        assert "id_bucket" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
        assert "In(prediction_id" in plan or "EqualTo(prediction_id" in plan
        many = [(f"p{i}",) for i in range(4_000) if i % 300 == 0] + [("q",)]
        many = staging.put(spark.createDataFrame(many, "prediction_id string"), "ids")
        buckets = many.select(log.bucket()).distinct().count()
        read = log.holding(many).select(F.input_file_name()).distinct().count()
        assert buckets < 16 and read <= files * (buckets + 2) / 16
    log.append(logged(spark, "p17", "new"), "001001")
    assert log.read().filter("batch = '001001'").select("prediction_id").first()[0] == "new"
    small = log.compact(str(tmp_path / "small"), "001002")
    assert small.read().count() == 4_001
    assert small.read().select(F.input_file_name()).distinct().count() <= 2 * 16
    small.append(logged(spark, "p3999", "newer"), "001003")
    assert small.read().count() == 4_002


def test_deletions_are_tombstones(spark, tmp_path):
    log = stores.PredictionLog(spark, str(tmp_path / "log"))
    labels = stores.LabelStore(spark, str(tmp_path / "labels"))
    log.append(logged(spark, "a", "b"), "0")
    log.append(logged(spark, "c", version="2"), "1")
    labels.upsert(log, labelled(spark, ("a", "x", 1), ("c", "x", 1), ("zz", "x", 1)), "0")
    labels.upsert(log, labelled(spark, ("c", "y", 2)), "1")
    files = log.read().select(F.input_file_name()).distinct().count()
    for _ in range(2):  # a repeated deletion changes nothing
        stores.purge(log, labels, F.col("model_version") == "2", "gone")
        assert ids_of(log.live()) == ["a", "b"] and ids_of(labels.current()) == ["a"]
        assert log.tombstones().read().count() == 1 and labels.tombstones().read().count() == 2
    assert log.read().select(F.input_file_name()).distinct().count() == files
    # a batch that runs again brings nothing back, a later one may log the id anew
    log.append(logged(spark, "c", version="2"), "1")
    assert ids_of(log.live()) == ["a", "b"]
    log.append(logged(spark, "c", "a", version="3"), "2")
    assert [(r.prediction_id, r.model_version) for r in log.live().orderBy("prediction_id").collect()] == [
        ("a", "1"), ("b", "1"), ("c", "3")]
    left = labels.upsert(log, labelled(spark, ("c", "z", 3)), "2")
    assert left.count() == 0 and ids_of(labels.current()) == ["a", "c"]
    compacted = log.compact(str(tmp_path / "log2"), "3")
    assert ids_of(compacted.read()) == ["a", "b", "c"] and not compacted.tombstones().exists()
    fewer = labels.compact(str(tmp_path / "labels2"), "3")
    assert ids_of(fewer.read()) == ["a", "c"]
    stores.purge(log, labels, F.lit(None).cast("boolean"), "nothing")
    assert ids_of(log.live()) == ["a", "b", "c"]


def test_staged_tables_go_with_their_owner(spark):
    import os

    with Staging(spark) as staging:
        staging.put(spark.range(3), "some")
        (path,) = staging.paths
        assert os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


def test_the_stream_logs_the_first_row_of_an_id(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = [(i, T0 + timedelta(hours=h), "1", float(x)) for i, h, x in
            [("a", 5, 5), ("a", 2, 2), ("a", 9, 9), ("b", 1, 1), (None, 4, 4), (None, 3, 3)]]
    df = spark.createDataFrame(rows, "prediction_id string, predicted_at timestamp, model_version string, adr double")
    df.repartition(3).write.parquet(source)
    jobs.stream_prediction_log(jobs.file_stream(spark, source, df.schema), sink, state).awaitTermination()
    got = {(r.prediction_id, r.adr) for r in spark.read.parquet(sink).collect()}
    assert got == {("a", 2.0), ("b", 1.0), (None, 3.0)}


# -- moments --------------------------------------------------------------


def test_merged_moments_equal_the_whole(spark):
    rows = [(str(i % 3), i % 7, 1e9 + (i * 37 % 101) if i % 5 else None, float("nan")) for i in range(500)]
    df = spark.createDataFrame(rows, "model_version string, day int, x double, y double")
    parts = drift.moments(df, ["x", "y"], ["model_version", "day"])
    merged = drift.merge_moments(parts, ["model_version"])
    got = {(r.model_version, r.feature): r for r in drift.moments_profile(merged, ["model_version"]).collect()}
    want = drift.reference_profile(df, ["x", "y"], ["model_version"]).collect()
    assert len(got) == len([r for r in want if r.feature == "x"]) == 3
    for r in want:
        if r.feature == "x":
            mine = got[r.model_version, "x"]
            assert mine.n_rows == r.n_rows and mine.missing_rate == pytest.approx(r.missing_rate)
            assert mine.mean == pytest.approx(r["mean"], rel=1e-15) and mine.std == pytest.approx(r["std"])
    empty = drift.merge_moments(parts.filter("false"), ["model_version"])
    assert empty.count() == 0


@pytest.mark.parametrize("begin, end", [(0, 72), (5, 50), (5, 20), (24, 48), (30, 31), (0, 24), (23.5, 24.5)])
def test_windows_from_summaries_equal_the_rows(spark, begin, end):
    rows = [(T0 + timedelta(hours=i / 4), str(i % 2), f'{{"adr": {i % 11}}}') for i in range(4 * 72)]
    log = spark.createDataFrame(rows, "predicted_at timestamp, model_version string, features string")
    log = log.withColumn("day", F.to_date("predicted_at"))
    summaries = drift_job.day_summaries(log, ["adr"])
    at = lambda h: F.lit(T0 + timedelta(hours=h)).cast("timestamp")
    found = drift_job.window_moments(log, summaries, at(begin), at(end), ["adr"])
    inside = log.filter((F.col("predicted_at") >= at(begin)) & (F.col("predicted_at") < at(end)))
    flat = drift.flatten_features(inside, "features", ["adr"])
    want = drift.moments(flat, ["adr"], ["model_version"])
    plain = lambda df: {
        r.model_version: (r.n_rows, r.moments[0].n, round(r.moments[0].mean, 9), round(r.moments[0].spread, 6))
        for r in df.collect()
    }
    assert plain(found) == plain(want)


def test_late_rows_and_new_profiles_amend_windows(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    store = jobs.WindowStore(spark, str(tmp_path / "windows"))
    schema = "prediction_id string, predicted_at timestamp, model_version string, adr double"
    published = [("1", "adr", 10.0, 2.0, 0.0, 9)]
    policy = DriftPolicy(window_hours=24, min_predictions=4, alpha=0.01)
    sent = []

    def send(*rows):
        df = spark.createDataFrame([(f"p{h}", T0 + timedelta(hours=h), v, float(x)) for h, v, x in rows], schema)
        df.write.mode("append").parquet(source)
        query = jobs.stream_amended_windows(
            jobs.file_stream(spark, source, df.schema), store, ["adr"],
            lambda: spark.createDataFrame(published, stores.PROFILE_SCHEMA), state, policy,
        )
        query.awaitTermination()
        sent.append(len(rows))
        counted = jobs.sink_counters(query).orderBy("batch_id").collect()
        assert [r.rows_in for r in counted] == sent
        return {
            (r.window_start - T0).days: (r.n_rows, r.status) for r in store.current().collect() if r.model_version == "1"
        }

    assert send((1, "1", 10), (2, "1", 10), (3, "1", 10), (50, "1", 10), (4, "2", 1), (5, None, 1)) == {
        0: (3, "SKIPPED"), 2: (1, "SKIPPED")}
    assert [(r.window_start - T0).days for r in store.current("1 hour").collect()] == [0, 0]
    # a row that is two days late re-opens the first window
    assert send((6, "1", 10))[0] == (4, "OK")
    published[0] = ("1", "adr", 90.0, 2.0, 0.0, 9)
    assert send((7, "1", 10))[0] == (5, "ALERT")
    # the same micro-batch once more changes nothing
    again = spark.createDataFrame([("p7", T0 + timedelta(hours=7), "1", 10.0)], schema)
    profiles = lambda: spark.createDataFrame(published, stores.PROFILE_SCHEMA)
    jobs.window_batch(store, again, 2, ["adr"], profiles, policy, None)
    assert {r.n_rows for r in store.current().collect() if r.window_start == T0 and r.model_version == "1"} == {5}
