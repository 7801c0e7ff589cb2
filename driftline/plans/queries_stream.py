"""Queries: the streams over the event table, run to the end of the input."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import half_up, utc_day, utc_instant
from ..operators.contracts import Field, ScoringField
from ..operators.drift import DriftPolicy
from ..runtime import scratch_path, stage_table
from ..sources.stores import LabelStore
from ..streaming import jobs
from .queries_log import FEATURES, _LOG_SQL, critical_z, event_profiles
from .registry import half_up_sql, query
from .testbed import table


def table_stream(spark, sf_dir, name):
    """A table as a file stream, whether it is one file or a folder of files.

    A stream refuses the plain path of a file and filters the names inside a folder; a pattern
    of the path stands for either.
    """
    schema = table(spark, sf_dir, name).schema
    return jobs.file_stream(spark, f"{sf_dir}/{name}.parque[t]", schema)


def event_stream(spark, sf_dir):
    """The event table as a file stream."""
    return table_stream(spark, sf_dir, "events")


def _twice_sent(events):
    """Every third event arrives a second time."""
    copies = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return events.select(
        F.col("event_id").cast("string").alias("prediction_id"),
        utc_instant("ts").alias("predicted_at"),
        F.col("event_type").alias("model_version"),
        F.get_json_object("props", "$.k").alias("k"),
        "value",
        F.explode(copies).alias("copy"),
    )


_LOG_FIELDS = (
    ScoringField(Field("k", "bigint", at_least=10, at_most=90)),
    ScoringField(Field("value", "double", at_least=0)),
)


def _scored(events):
    accepted = jobs.accepted_rows(
        _twice_sent(events), _LOG_FIELDS, ("prediction_id", "predicted_at", "model_version")
    )
    return accepted.withColumn(
        "predicted_segment", F.when(F.col("value") > 10, "high").otherwise("low")
    )


def _logged(spark, sf_dir):
    path = scratch_path(spark, "stream-log")
    stream = jobs.stream_prediction_log(
        event_stream(spark, sf_dir),
        path,
        scratch_path(spark, "stream-log-state"),
        score=_scored,
        watermark="2 hours",
    )
    stream.awaitTermination()
    return stream, path


@query(
    """SELECT event_id::VARCHAR AS prediction_id, event_type AS model_version,
       CASE WHEN value > 10 THEN 'high' ELSE 'low' END AS predicted_segment,
       ts::DATE::VARCHAR AS predicted_date
FROM events WHERE (props->>'$.k')::BIGINT BETWEEN 10 AND 90 AND value >= 0"""
)
def stream_log(spark, sf_dir):
    _, path = _logged(spark, sf_dir)
    return spark.read.parquet(path).select(
        "prediction_id",
        "model_version",
        "predicted_segment",
        F.col("predicted_date").cast("string").alias("predicted_date"),
    )


@query(
    """WITH sent AS (
  SELECT event_id % 3 = 0 AS twice FROM events
  WHERE (props->>'$.k')::BIGINT BETWEEN 10 AND 90 AND value >= 0)
SELECT (SELECT count(*) FROM events) AS rows_in, 0::BIGINT AS rows_late,
       count(*) FILTER (WHERE twice) AS rows_duplicate FROM sent"""
)
def stream_counters(spark, sf_dir):
    stream, _ = _logged(spark, sf_dir)
    counters = jobs.sink_counters(stream)
    names = ("rows_in", "rows_late", "rows_duplicate")
    return counters.agg(*[F.sum(name).alias(name) for name in names])


@query(
    """SELECT doc_id::VARCHAR AS prediction_id,
       (CASE WHEN doc_id % 4 = 0 THEN toxic ELSE quality END)::VARCHAR AS actual_segment
FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang <> 'de')"""
)
def stream_labels(spark, sf_dir):
    """Labels for logged documents, a quarter of them corrected within the stream.

    Documents in German were never scored: their labels stay pending.
    """
    corrected = F.when(
        F.col("doc_id") % 4 == 0,
        F.array(
            F.struct(F.col("quality").alias("segment"), F.lit(1).alias("second")),
            F.struct(F.col("toxic").alias("segment"), F.lit(2).alias("second")),
        ),
    ).otherwise(F.array(F.struct(F.col("quality").alias("segment"), F.lit(1).alias("second"))))
    source = (
        table_stream(spark, sf_dir, "labels")
        .select("doc_id", F.inline(corrected))
        .select(
            F.col("doc_id").cast("string").alias("prediction_id"),
            F.col("segment").cast("string").alias("actual_segment"),
            F.timestamp_seconds("second").alias("labeled_at"),
            F.lit("stream").alias("label_source"),
        )
    )
    documents = table(spark, sf_dir, "documents").filter("lang <> 'de'")
    predictions = documents.select(F.col("doc_id").cast("string").alias("prediction_id"))
    store = LabelStore(spark, scratch_path(spark, "stream-labels"))
    jobs.stream_label_reconcile(
        source,
        lambda: predictions,
        store,
        scratch_path(spark, "stream-pending"),
        scratch_path(spark, "stream-labels-state"),
    ).awaitTermination()
    return store.current().select("prediction_id", "actual_segment")


@query(
    f"""WITH {_LOG_SQL},
days AS (
  SELECT model_version, feature, ts::DATE AS day, count(*) AS n, avg(x) AS mean FROM cells
  GROUP BY 1, 2, 3),
scored AS (
  SELECT model_version, feature, day, n,
         (d.mean - p.mean) / (p.std / sqrt(n::DOUBLE)) AS z
  FROM days d JOIN profile p USING (model_version, feature)
  WHERE n >= 5 AND day + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR)
SELECT model_version, day::VARCHAR AS day, max(n)::BIGINT AS n_rows,
       CASE WHEN bool_or(abs(z) > {critical_z(0.05)!r}::DOUBLE) THEN 'ALERT' ELSE 'OK' END
         AS status,
       {half_up_sql("max(z) FILTER (WHERE feature = 'value')", 6)} AS z_value
FROM scored GROUP BY 1, 2"""
)
def stream_drift(spark, sf_dir):
    """Daily drift verdicts per event type with at least five events; the open day is left out."""
    source = event_stream(spark, sf_dir).select(
        utc_instant("ts").alias("predicted_at"),
        F.col("event_type").alias("model_version"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        "value",
    )
    policy = DriftPolicy(window_hours=24, min_predictions=5)
    profiles = stage_table(event_profiles(spark, sf_dir), "profiles")
    store = jobs.WindowStore(spark, scratch_path(spark, "stream-drift"))
    jobs.stream_amended_windows(
        source, store, FEATURES, lambda: profiles, scratch_path(spark, "stream-drift-state"), policy
    ).awaitTermination()
    value = F.filter("features", lambda c: c["feature"] == "value")[0]["z_score"]
    day = utc_day("window_start")
    return (
        store.current(watermark="2 hours")
        .filter("status <> 'SKIPPED'")
        .select(
            "model_version",
            day.cast("string").alias("day"),
            "n_rows",
            "status",
            half_up(value, 6).alias("z_value"),
        )
    )
