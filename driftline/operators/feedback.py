"""Prediction log and late labels as table operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import draw, draw_digits, utc_day, utc_micros
from ..runtime import null_safe_join, stage_table
from .evaluation import summary_scores
from .ranking import order_value, rank_cuts, with_cuts

LABEL_COLUMNS = ("prediction_id", "actual_segment", "labeled_at", "label_source")
LABEL_SCHEMA = (
    "prediction_id string, actual_segment string, labeled_at timestamp, label_source string"
)


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of every key; a hot key shrinks before it is shuffled."""
    return _one_per_key(df, key, order, F.min)


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of every key; a hot key shrinks before it is shuffled."""
    return _one_per_key(df, key, order, F.max)


def _one_per_key(df: DataFrame, key: str, order: list[str], pick) -> DataFrame:
    # the other columns break ties, so the result does not depend on task order
    rest = [c for c in df.columns if c not in (key, *order)]
    picked = df.groupBy(key).agg(pick(F.struct(*order, *rest)).alias("row"))
    return picked.select(
        *[F.col(key) if c == key else F.col("row")[c].alias(c) for c in df.columns]
    )


#: A log, or what gives the rows of it that may hold one of some staged ids.
Log = DataFrame | Callable[[DataFrame], DataFrame]
Stage = Callable[[DataFrame, str], DataFrame]


def _holding(log: Log, ids: DataFrame) -> DataFrame:
    return log if isinstance(log, DataFrame) else log(ids)


def append_predictions(
    log: DataFrame, batch: DataFrame, key: str = "prediction_id", order: str = "predicted_at"
) -> DataFrame:
    """The log with the batch appended; an id that is already there is ignored."""
    return log.unionByName(new_predictions(log, batch, key, order))


def new_predictions(
    log: Log,
    batch: DataFrame,
    key: str = "prediction_id",
    order: str = "predicted_at",
    stage: Stage = stage_table,
) -> DataFrame:
    """The rows of the batch to append: the first per id, without ids already logged.

    The reduced batch is staged, so Spark knows its size: a small one is broadcast to the
    scan of the log's ids, which then are neither sorted nor shuffled. A null id is an id.
    """
    first = stage(first_per_key(batch, key, [order]), "batch")
    return unlogged(log, first, key)


def unlogged(log: Log, staged: DataFrame, key: str = "prediction_id") -> DataFrame:
    """The staged rows whose id the log does not hold."""
    held = _holding(log, staged.select(key)).select(key)
    logged = null_safe_join(held, staged.select(key), [key], "left_semi")
    return null_safe_join(staged, logged, [key], "left_anti")


def recent_predictions(
    log: DataFrame,
    as_of: Column,
    window_hours: float,
    max_rows: int | None = None,
    model_version: str | None = None,
    keep: tuple[str, ...] = ("features",),
) -> DataFrame:
    """Per model version, the rows of the trailing window; with ``max_rows`` the newest of them.

    ``as_of`` has the type of ``predicted_at`` (zoned or not), so that the filter reaches
    the scan. Rows with the same time are ordered by the hash of their id. The cut is an order
    value per version (see ranking), so no task gathers the rows; rows without a version
    never match.
    """
    begin = as_of - F.make_dt_interval(secs=F.lit(window_hours * 3600.0).cast("decimal(18,6)"))
    recent = log.filter((F.col("predicted_at") >= begin) & F.col("model_version").isNotNull())
    zoneless = isinstance(log.schema["predicted_at"].dataType, T.TimestampNTZType)
    if "predicted_date" in log.columns:
        first_day = F.to_date(begin) if zoneless else utc_day(begin)
        recent = recent.filter(F.col("predicted_date") >= first_day)
    if model_version is not None:
        recent = recent.filter(F.col("model_version") == str(model_version))
    columns = ["model_version", *keep]
    if max_rows is None:
        return recent.select(*columns)
    sizes = recent.groupBy("model_version").agg(F.count("*").alias("n"))
    if sizes.filter(F.col("n") > max_rows).isEmpty():
        return recent.select(*columns)
    micros = utc_micros("predicted_at") if zoneless else F.unix_micros("predicted_at")
    # columns of their own, so that the digits do not compute them again and again
    timed = recent.withColumns({"__micros": micros, "__draw": draw(0, "prediction_id")})
    digits = newest_first_digits()
    cuts = rank_cuts(timed, ["model_version"], digits, {"__oldest": F.lit(max_rows)})
    return (
        with_cuts(timed, ["model_version"], cuts)
        .filter(order_value(digits) <= F.col("__oldest"))
        .select(*columns)
    )


def newest_first_digits(micros: str = "__micros", drawn: str = "__draw") -> list[Column]:
    """Descending time as hours, seconds and microseconds, then the hashed key."""
    time, hour, second = F.col(micros), F.lit(3_600_000_000), F.lit(1_000_000)
    return [
        -F.floor(time / hour),
        -F.floor(F.pmod(time, hour) / second),
        -F.pmod(time, second),
        *draw_digits(drawn),
    ]


@dataclass(frozen=True)
class LabelUpsert:
    """The label table after a batch, the batch rows that found no prediction, the counts."""

    labels: DataFrame
    unmatched: DataFrame
    counts: DataFrame


def matched_labels(predictions: Log, batch: DataFrame, stage: Stage = stage_table) -> DataFrame:
    """The last label per id with ``n_sent`` and whether the prediction is known.

    Staged: every consumer sees the same matches, even while the log grows. The reduced
    batch is staged first, so Spark knows its size and broadcasts a small one to the scan
    of the log.
    """
    rest = [c for c in batch.columns if c not in ("prediction_id", "labeled_at")]
    last = batch.groupBy("prediction_id").agg(
        F.max(F.struct("labeled_at", *rest)).alias("row"), F.count("*").alias("n_sent")
    )
    sent = stage(
        last.select(
            *[
                F.col(c) if c == "prediction_id" else F.col("row")[c].alias(c)
                for c in batch.columns
            ],
            "n_sent",
        ),
        "labels",
    )
    held = _holding(predictions, sent.select("prediction_id"))
    known = held.select("prediction_id").join(
        sent.select("prediction_id"), "prediction_id", "left_semi"
    )
    return stage(
        sent.join(known.withColumn("known", F.lit(True)), "prediction_id", "left").withColumn(
            "known", F.coalesce("known", F.lit(False))
        ),
        "matched",
    )


def upsert_labels(predictions: DataFrame, labels: DataFrame, batch: DataFrame) -> LabelUpsert:
    """Insert or overwrite labels of known predictions; ids never logged are skipped.

    A label of the batch replaces a stored one whatever its time; within the batch the
    last one wins. ``counts`` holds (accepted, skipped) rows sent.
    """
    matched = matched_labels(predictions, batch)
    accepted = matched.filter("known").select(*labels.columns)
    untouched = labels.join(accepted.select("prediction_id"), "prediction_id", "left_anti")
    counts = matched.agg(
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n_sent"))), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum(F.when(~F.col("known"), F.col("n_sent"))), F.lit(0)).alias("skipped"),
    )
    return LabelUpsert(
        untouched.unionByName(accepted),
        matched.filter("NOT known").select(*batch.columns),
        counts,
    )


def purge_predictions(
    predictions: DataFrame, labels: DataFrame, doomed: Column
) -> tuple[DataFrame, DataFrame]:
    """Delete the doomed predictions and, with them, their labels."""
    kept = predictions.filter(~F.coalesce(doomed, F.lit(False)))
    return kept, labels.join(kept.select("prediction_id"), "prediction_id", "left_semi")


def labelled_accuracy(
    predictions: DataFrame, labels: DataFrame, keys: list[str | Column]
) -> DataFrame:
    """Scores of the labelled predictions per key (a version, a window)."""
    pairs = predictions.join(
        labels.select("prediction_id", "actual_segment"), "prediction_id", "inner"
    )
    counts = pairs.groupBy(
        *keys,
        F.col("actual_segment").alias("true"),
        F.col("predicted_segment").alias("predicted"),
    ).agg(F.count("*").alias("n"))
    names = [c for c in counts.columns if c not in ("true", "predicted", "n")]
    return summary_scores(counts, names).select(
        *names,
        "n",
        "accuracy",
        F.col("weighted_f1").alias("f1_weighted"),
        F.col("macro_f1").alias("f1_macro"),
    )
