"""Work and memory that must not grow faster than the input."""

import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from driftline.operators import evaluation, features, modeling
from driftline.plans import queries_model
from driftline.runtime import Staging, compiled_methods, dropped_shuffles, stage_table
from driftline.sources.stores import PREDICTION_SCHEMA, PredictionLog


def test_more_ties_make_more_ranges_of_the_auc(spark, monkeypatch):
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("true"),
        (F.xxhash64("id") % 1_000).cast("double").alias("score"),
    )
    cut = []

    def auc():
        found = evaluation.roc_auc_ovr(rows, "true", {"a": "score"}).collect()
        return [tuple(r) for r in found]

    whole = auc()
    deal = type(rows).repartitionByRange

    def dealt(df, number, *columns):
        cut.append(number)
        return deal(df, number, *columns)

    monkeypatch.setattr(type(rows), "repartitionByRange", dealt)
    monkeypatch.setattr(evaluation, "RANGE_ROWS", 50)
    assert auc() == whole
    assert cut[0] >= 1_000 // 50


def test_assembled_rows_are_staged_before_they_are_learned_from(spark, tables, monkeypatch):
    read = []

    class Learned(Exception):
        pass

    def learned(rows, spec):
        read.extend(rows.inputFiles())
        raise Learned

    monkeypatch.setattr(features, "fit_preprocessor", learned)
    try:
        queries_model.feat_assembled(spark, tables)
    except Learned:
        pass
    assert read and not [name for name in read if tables in name]


@pytest.mark.parametrize("name", ["model_backtest", "model_score", "score_log"])
def test_bookings_are_joined_once_for_fitting_and_scoring(spark, tables, monkeypatch, name):
    read = []

    class Fitted(Exception):
        pass

    def fitted(rows, *_, **__):
        read.extend(rows.inputFiles())
        raise Fitted

    monkeypatch.setattr(modeling, "fit_forest", fitted)
    with pytest.raises(Fitted):
        getattr(queries_model, name)(spark, tables)
    assert read and not [name for name in read if tables in name]


def test_vectors_are_staged_before_they_are_binned(spark, monkeypatch):
    read = []

    class Fitted(Exception):
        pass

    def fitted(rows, *_):
        read.extend(rows.inputFiles())
        raise Fitted

    monkeypatch.setattr(modeling, "fit_classifier", fitted)
    rows = spark.range(60).select((F.col("id") % 2).cast("string").alias("kind"), F.col("id").cast("double").alias("x"))
    with pytest.raises(Fitted):
        modeling.fit_forest(rows, features.ModelInputs.of(number=("x",)), "kind")
    assert read and all("/vectors-" in name for name in read)


def test_the_first_batch_of_a_log_is_not_compared_with_it(spark, tmp_path, monkeypatch):
    log = PredictionLog(spark, str(tmp_path / "log"))
    row = ("a", datetime(2024, 2, 1), "m", "live", "1", "x", 0.5, 0.5, "{}")
    rows = spark.createDataFrame([row, row], PREDICTION_SCHEMA)
    with monkeypatch.context() as patch:
        patch.setattr(PredictionLog, "live_holding", lambda *_: pytest.fail("compared"))
        log.append(rows, "1")
    log.append(rows, "2")
    assert [r.batch for r in log.read().collect()] == ["1"]


def test_the_first_batch_of_a_log_is_written_once(spark, tmp_path, monkeypatch):
    log = PredictionLog(spark, str(tmp_path / "log"))
    row = ("a", datetime(2024, 2, 1), "m", "live", "1", "x", 0.5, 0.5, "{}")
    with monkeypatch.context() as patch:
        patch.setattr(Staging, "put", lambda *_: pytest.fail("staged"))
        log.append(spark.createDataFrame([row, row], PREDICTION_SCHEMA), "1")
    assert [r.batch for r in log.read().collect()] == ["1"]


def test_staged_tables_are_written_by_methods_that_the_jvm_compiles(spark, monkeypatch):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(limit), []
    writer = type(spark.range(1).write)
    write = writer.parquet

    def kept(self, *args, **kwargs):
        seen.append(int(spark.conf.get(limit)))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(writer, "parquet", kept)
    assert stage_table(spark.range(3), "rows").count() == 3
    with Staging(spark) as staging:
        staging.put(spark.range(3), "rows")
    assert seen == [8_000] * 2 and spark.conf.get(limit) == before
    spark.conf.set(limit, "4000")
    try:
        with compiled_methods(spark):
            assert spark.conf.get(limit) == "4000"
    finally:
        spark.conf.set(limit, before)


def test_shuffle_files_go_when_a_table_or_a_batch_is_written(spark, tmp_path):
    context = spark.sparkContext._jsc.sc()
    jvm = spark.sparkContext._jvm
    folders = [str(f) for f in context.env().blockManager().diskBlockManager().localDirs()]
    there = lambda: {
        f for top in folders for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    jvm.System.gc()
    time.sleep(2)
    before = there()
    rows = spark.range(2_000).repartition(3, "id").groupBy((F.col("id") % 9).alias("k")).count()
    stage_table(rows, "rows")
    with Staging(spark) as staging:
        assert staging.put(rows, "rows").count() == 9
    log = PredictionLog(spark, str(tmp_path / "log"))
    log.append(spark.createDataFrame([("a", datetime(2024, 2, 1), "m", "live", "1", "x", 0.5, 0.5, "{}")] * 2, PREDICTION_SCHEMA), "1")
    for _ in range(20):
        if not there() - before:
            break
        time.sleep(0.5)
    # counting leaves files of its own, a few rows of one stage
    assert len(there() - before) <= 1


def test_the_setting_comes_back_after_the_last_of_several_blocks(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    one, two = dropped_shuffles(spark), dropped_shuffles(spark)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(name) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(name) == before
