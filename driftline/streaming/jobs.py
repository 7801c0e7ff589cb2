"""Prediction log, label reconciliation and drift windows as streams."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType

from ..functions.values import utc_day
from ..operators.contracts import ScoringField, judge_scoring_rows
from ..operators.drift import (
    MOMENTS,
    DriftPolicy,
    batch_statistics,
    merge_moments,
    moments,
    moments_batch,
    nest_profile,
)
from ..plans.drift_job import judge_batches
from ..operators.feedback import Log, new_predictions
from ..runtime import Staging, small_side
from ..sources.stores import (
    BUCKET,
    BUCKETS,
    LABEL_SCHEMA,
    BatchTable,
    LabelStore,
    PredictionLog,
    folder_exists,
)


#: The checks of a verdict as they are stored.
CHECKS = (
    "array<struct<feature:string,reference_mean:double,batch_mean:double,z_score:double,"
    "p_value:double,status:string>>"
)
#: Below a log; readers of the log skip folders of this kind.
COUNTERS_FOLDER = "_counters"
_COUNTERS = (
    "batch_id bigint, rows_in bigint, rows_late bigint, rows_duplicate bigint, state_rows bigint"
)
_STORED_COUNTERS = f"{_COUNTERS}, newest timestamp"


def file_stream(
    spark: SparkSession,
    path: str,
    schema,
    format: str = "parquet",
    files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """New files of a folder, paced by the number of files per micro-batch."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(format).load(path)


def accepted_rows(
    source: DataFrame, fields: tuple[ScoringField, ...], keep: tuple[str, ...]
) -> DataFrame:
    """The rows of a stream that pass the scoring contract."""
    return judge_scoring_rows(source, fields, keep).filter(F.size("reasons") == 0).drop("reasons")


def log_batch(
    table: BatchTable,
    counters: BatchTable,
    df: DataFrame,
    batch_id: int,
    score: Callable[[DataFrame], DataFrame] | None,
    watermark: str,
) -> None:
    """Log the first rows, by time, of ids that no earlier micro-batch has, and count.

    Of the log only the buckets of the batch's ids are read; what it holds and its newest time
    are carried on in the counters. The log is written before the counters; running a batch
    again replaces both folders.
    """
    name = batch_name(batch_id)
    with Staging(table.spark) as staging:
        rows = df.persist()
        try:
            scored = staging.put(rows if score is None else score(rows), "scored")
            rows_in = rows.count()
        finally:
            rows.unpersist()
        fresh = new_predictions(
            lambda ids: table.holding(ids).filter(F.col("batch") < name), scored, stage=staging.put
        )
        fresh = staging.put(fresh.withColumn("predicted_date", utc_day("predicted_at")), "fresh")
        table.write(fresh, name)
        before = counters.read().filter(F.col("batch") < name)
        before = before.agg(F.max("state_rows").alias("held"), F.max("newest").alias("newest"))
        late = F.col("predicted_at") < F.col("newest") - F.expr(f"INTERVAL {watermark}")
        sent = scored.join(F.broadcast(before.select("newest")), how="cross").agg(
            F.count("*").alias("n"), F.count_if(late).alias("late")
        )
        new = fresh.agg(F.count("*").alias("new"), F.max("predicted_at").alias("last"))
        row = before.join(F.broadcast(sent), how="cross").join(F.broadcast(new), how="cross").select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.lit(rows_in).cast("bigint").alias("rows_in"),
            F.col("late").alias("rows_late"),
            (F.col("n") - F.col("new")).alias("rows_duplicate"),
            (F.coalesce("held", F.lit(0)) + F.col("new")).alias("state_rows"),
            F.greatest("newest", F.col("last").cast("timestamp")).alias("newest"),
        )
        counters.write(staging.put(row, "counters"), name)


def stream_prediction_log(
    source: DataFrame,
    path: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] | None = None,
    watermark: str = "1 hour",
    trigger: dict | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Score a stream and append it, once per id, to batch and day folders of Parquet files.

    Every micro-batch replaces the folder of its own name, so a restart neither loses nor
    repeats rows. Of rows with one id the first by time is logged. Ids of any age are compared,
    in the buckets of the batch's ids; no row is refused for its time. Rows older than the newest
    logged before their batch less the watermark are logged and counted as late, below
    ``_counters``. A path belongs to one checkpoint and one number of buckets.
    """
    spark = source.sparkSession
    shape = source if score is None else score(source)
    if "batch" in shape.columns:
        raise ValueError("batch names the folders of the log; rename this column")
    if folder_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} holds a log of the file sink, whose readers skip other folders")
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        for f in shape.schema.fields
        if f.name not in ("predicted_date", BUCKET)
    )
    table = BatchTable(spark, path, schema, "predicted_date", buckets=buckets)
    counters = BatchTable(spark, f"{path}/{COUNTERS_FOLDER}", _STORED_COUNTERS)
    query = (
        source.writeStream.foreachBatch(
            lambda df, batch_id: log_batch(table, counters, df, batch_id, score, watermark)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.counters = counters
    return query


def counted(
    counters: BatchTable, work: Callable[[DataFrame, int], int | None]
) -> Callable[[DataFrame, int], None]:
    """The work on a micro-batch, and a counters row for it: rows in, and rows held behind it."""

    def run(df: DataFrame, batch_id: int) -> None:
        rows = df.persist()
        try:
            held = work(rows, batch_id)
            row = (batch_id, rows.count(), 0, 0, held or 0)
        finally:
            rows.unpersist()
        counters.write(counters.spark.createDataFrame([row], _COUNTERS), batch_name(batch_id))

    return run


def _counting_stream(
    source: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None,
    work: Callable[[DataFrame, int], int | None],
) -> StreamingQuery:
    """Start a stream of micro-batches that counts them below the path it writes to."""
    counters = BatchTable(source.sparkSession, f"{path}/{COUNTERS_FOLDER}", _COUNTERS)
    query = (
        source.writeStream.foreachBatch(counted(counters, work))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.counters = counters
    return query


def batch_name(batch_id: int) -> str:
    """Sortable folder name of a micro-batch."""
    return f"{batch_id:012d}"


def stream_log_to_store(
    source: DataFrame, log: PredictionLog, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append to the log store, ignoring every id that was ever logged."""
    return _counting_stream(
        source, log.path, checkpoint, trigger, lambda df, i: log.append(df, batch_name(i))
    )


def reconcile_batch(
    predictions: Log | PredictionLog,
    labels: LabelStore,
    pending: BatchTable,
    df: DataFrame,
    batch_id: int,
) -> int:
    """Store the labels of one micro-batch together with those still waiting.

    Labels whose prediction is not logged yet wait in ``pending`` under the name of the
    batch, which the next batch reads; their number is returned. Running a batch again writes
    the same folders.
    """
    waiting = pending.read().filter(F.col("batch") == batch_name(batch_id - 1)).drop("batch")
    name = batch_name(batch_id)
    unmatched = labels.upsert(predictions, df.unionByName(waiting), name)
    pending.write(unmatched, name)
    return unmatched.count()


def stream_label_reconcile(
    source: DataFrame,
    predictions: Callable[[], Log | PredictionLog],
    labels: LabelStore,
    pending_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert late labels; unknown ids are tried again with every following batch.

    ``predictions`` is called per batch, so that freshly logged predictions are seen; of a
    PredictionLog only the buckets of the labelled ids are read.
    """
    pending = BatchTable(labels.spark, pending_path, LABEL_SCHEMA)
    return _counting_stream(
        source,
        labels.path,
        checkpoint,
        trigger,
        lambda df, i: reconcile_batch(predictions(), labels, pending, df, i),
    )


def drift_windows(
    source: DataFrame,
    profiles: DataFrame,
    features: list[str],
    policy: DriftPolicy = DriftPolicy(),
    watermark: str = "1 hour",
    slide: str | None = None,
) -> DataFrame:
    """(window, model_version, status, reason, n_rows, features) per closed window.

    source: predicted_at, model_version and the features as columns. Tumbling windows of
    the policy's length, or sliding ones. State holds one small aggregate per window and
    version; rows later than the watermark are dropped, which ``stream_amended_windows`` does not.
    """
    length = f"{round(policy.window_hours * 3600)} seconds"
    windows = batch_statistics(
        source.filter(F.col("model_version").isNotNull()).withWatermark("predicted_at", watermark),
        features,
        [F.window("predicted_at", length, slide).alias("window"), "model_version"],
    )
    baselines = small_side(nest_profile(profiles, ["model_version"]).drop("n_rows"))
    return judge_batches(windows.join(baselines.df, "model_version", "left"), policy)


def stream_drift_windows(
    report: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    return (
        report.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


@dataclass(frozen=True)
class WindowStore:
    """Drift windows that late rows may amend: mergeable moments and verdicts by micro-batch.

    The moments of a micro-batch lie in folders of the window's day; the verdict of a window is
    that of the newest batch that touched it.
    """

    spark: SparkSession
    path: str

    def parts(self) -> BatchTable:
        schema = (
            "window_start timestamp, window_end timestamp, model_version string, n_rows bigint, "
            f"moments {MOMENTS}, newest timestamp"
        )
        return BatchTable(self.spark, f"{self.path}/moments", schema, "day")

    def verdicts(self) -> BatchTable:
        schema = (
            "window_start timestamp, window_end timestamp, model_version string, n_rows bigint, "
            f"status string, reason string, features {CHECKS}"
        )
        return BatchTable(self.spark, f"{self.path}/verdicts", schema)

    def current(self, watermark: str | None = None) -> DataFrame:
        """The newest verdict per window and version; with a watermark only of closed windows."""
        keys = ["window_start", "model_version"]
        rows = self.verdicts().read()
        rest = [c for c in rows.columns if c not in (*keys, "batch")]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("row"))
        found = newest.select(*keys, "row.*")
        if watermark is None:
            return found
        mark = self.parts().read().agg(
            (F.max("newest") - F.expr(f"INTERVAL {watermark}")).alias("mark")
        )
        return found.join(F.broadcast(mark), F.col("window_end") <= F.col("mark")).drop("mark")


def window_batch(
    store: WindowStore,
    df: DataFrame,
    batch_id: int,
    features: list[str],
    profiles: Callable[[], DataFrame],
    policy: DriftPolicy,
    slide: str | None,
) -> None:
    """Add the moments of one micro-batch and judge every window that it touches anew.

    Windows of any age are found by their day; only those days are read. Profiles are read per
    batch. Running a batch again replaces its folders by the same rows.
    """
    name = batch_name(batch_id)
    length = f"{round(policy.window_hours * 3600)} seconds"
    keys = ["window_start", "window_end", "model_version"]
    with Staging(store.spark) as staging:
        rows = df.filter(F.col("model_version").isNotNull()).withColumn(
            "window", F.window("predicted_at", length, slide)
        )
        rows = rows.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
        part = moments(rows, features, [*keys])
        newest = rows.groupBy(*keys).agg(F.max("predicted_at").cast("timestamp").alias("newest"))
        part = part.join(newest, keys).withColumn("day", utc_day("window_start"))
        part = staging.put(part, "moments")
        store.parts().write(part, name)
        days = [r[0] for r in part.select("day").distinct().collect()]
        known = store.parts().read().filter(F.col("day").isin(days) & (F.col("batch") <= name))
        touched = part.select(*keys).distinct()
        merged = moments_batch(merge_moments(known.join(touched, keys, "left_semi"), keys))
        baselines = small_side(nest_profile(profiles(), ["model_version"]).drop("n_rows"))
        judged = judge_batches(merged.join(baselines.df, "model_version", "left"), policy)
        store.verdicts().write(staging.put(judged, "verdicts"), name)


def stream_amended_windows(
    source: DataFrame,
    store: WindowStore,
    features: list[str],
    profiles: Callable[[], DataFrame],
    checkpoint: str,
    policy: DriftPolicy = DriftPolicy(),
    slide: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Drift verdicts per window that no row is too late for.

    source: predicted_at, model_version and the features as columns. ``profiles`` is called
    per micro-batch, so that a newly published profile counts from then on.
    """
    return _counting_stream(
        source,
        store.path,
        checkpoint,
        trigger,
        lambda df, i: window_batch(store, df, i, features, profiles, policy, slide),
    )


def sink_counters(query: StreamingQuery) -> DataFrame:
    """Rows in, late, repeated and held (in the log or as state) per micro-batch of the query.

    The streams of this module that work by micro-batches write a row for each beside what they
    store, so batches of earlier runs and of streams of any length are all there. Of other
    queries Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` batches: a
    longer one raises.
    """
    counters = getattr(query, "counters", None)
    if counters is not None:
        return counters.read().select(*DataType.fromDDL(_COUNTERS).fieldNames())
    rows = []
    kept = query.recentProgress
    limit = int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(kept) >= limit:
        raise ValueError(f"only the last {limit} batches are known; raise numRecentProgressUpdates")
    for progress in kept:
        operators = progress["stateOperators"]
        metrics = [op["customMetrics"] for op in operators if op["customMetrics"]]
        rows.append(
            (
                progress["batchId"],
                progress["numInputRows"],
                sum(op["numRowsDroppedByWatermark"] for op in operators),
                sum(m.get("numDroppedDuplicateRows", 0) for m in metrics),
                sum(op["numRowsTotal"] for op in operators),
            )
        )
    return SparkSession.active().createDataFrame(rows, _COUNTERS)
