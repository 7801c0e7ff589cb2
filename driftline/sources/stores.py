"""File-backed stores: the prediction log, the labels, profiles and runs.

All of them are append-only Parquet. A write carries a batch name and replaces only the
folder of that name, so a repeated write changes nothing and a reader never meets a path
that is being rewritten. What is current is decided when reading: labels by the newest batch,
deletions by tombstones.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.values import utc_day
from ..operators.drift import MOMENTS
from ..operators.feedback import (
    LABEL_COLUMNS,
    LABEL_SCHEMA,
    Log,
    first_per_key,
    latest_per_key,
    matched_labels,
    new_predictions,
    unlogged,
)
from ..runtime import Staging, compiled_methods, dropped_shuffles, null_safe_join

# The columns of the two log tables.
PREDICTION_SCHEMA = (
    "prediction_id string, predicted_at timestamp, model_name string, model_alias string, "
    "model_version string, predicted_segment string, confidence double, margin double, "
    "features string"
)
PROFILE_SCHEMA = (
    "model_version string, feature string, mean double, std double, missing_rate double, "
    "n_rows bigint"
)
PERFORMANCE_SCHEMA = "run_id string, f1_weighted double, accuracy double, n_eval bigint"
SUMMARY_SCHEMA = f"model_version string, n_rows bigint, moments {MOMENTS}"
RUN_SCHEMA = "run_id string, kind string, key string, value string"


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _folder_text(value: str) -> str:
    """A value as it stands in the name of a partition folder."""
    return re.sub(r"""[\x00-\x1f"#%'*/:=?\\\x7f{}\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)


@dataclass(frozen=True)
class BatchTable:
    """Parquet folders ``batch=<name>`` below one path.

    With ``buckets`` the rows of a batch lie in folders by the hash of their ``key`` too, with
    Parquet's Bloom filters on it: ``holding`` finds keys without a scan of the whole table.
    The number of buckets belongs to the path.
    """

    spark: SparkSession
    path: str
    schema: str
    partition: str | None = None
    key: str = "prediction_id"
    buckets: int = 0

    def exists(self) -> bool:
        return folder_exists(self.spark, self.path)

    def columns(self) -> list[str]:
        return DataType.fromDDL(self.schema).fieldNames()

    def read(self) -> DataFrame:
        """All batches, with their ``batch`` name and the columns that name folders."""
        schema = self.schema + (f", {self.partition} date" if self.partition else "")
        schema += (f", {BUCKET} int" if self.buckets else "") + ", batch string"
        if not self.exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def bucket(self) -> Column:
        hashed = F.pmod(F.xxhash64(F.coalesce(F.col(self.key), F.lit(""))), F.lit(self.buckets))
        return hashed.cast("int")

    def write(self, df: DataFrame, batch: str) -> None:
        """Replace the folder of this batch as a whole, also by nothing or by other days.

        ``df`` must not read the batch that it replaces.
        """
        folders = [self.partition] if self.partition else []
        rows = df.select(*[f"`{name}`" for name in self.columns()], *folders)
        if self.buckets:
            folders = [*folders, BUCKET]
            rows = rows.withColumn(BUCKET, self.bucket()).hint("rebalance", *folders)
        writer = rows.write.mode("overwrite")
        if self.buckets:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true")
        if folders:
            writer = writer.partitionBy(*folders)
        with compiled_methods(self.spark), dropped_shuffles(self.spark):
            writer.option("partitionOverwriteMode", "static").parquet(
                f"{self.path}/batch={_folder_text(batch)}"
            )

    def holding(self, ids: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """The rows that may hold one of the staged ids: those of their buckets.

        At most ``buckets`` numbers reach the driver. A few ids are compared in the scan, where
        the Bloom filters skip what does not hold them.
        """
        rows = self.read() if rows is None else rows
        touched = [r[0] for r in ids.select(self.bucket()).distinct().collect()]
        rows = rows.filter(F.col(BUCKET).isin(touched))
        few = [r[0] for r in ids.limit(FEW_IDS + 1).collect()]
        if len(few) <= FEW_IDS and None not in few:
            rows = rows.filter(F.col(self.key).isin(few))
        return rows


#: The folder column of the hashed key, and the number of buckets of a new log.
BUCKET, BUCKETS = "id_bucket", 8
#: Ids that are compared in the scan; Spark hands no longer lists to Parquet.
FEW_IDS = 10


class DeletableTable(BatchTable):
    """A bucketed table whose rows are deleted by tombstones.

    A tombstone names an id and the batch that holds it, so an id may be written anew by a later
    batch. Tombstones are batches themselves: a repeated deletion replaces its own folder by the
    same rows. ``compacted_into`` leaves them and what they delete behind.
    """

    def tombstones(self) -> BatchTable:
        schema = f"{self.key} string, of_batch string"
        return BatchTable(
            self.spark, f"{self.path}/_deleted", schema, key=self.key, buckets=self.buckets
        )

    def live(self, besides: str | None = None, within: DataFrame | None = None) -> DataFrame:
        """Rows without a tombstone, those of the deletion ``besides`` not counted."""
        rows, graves = self.read() if within is None else within, self.tombstones()
        if not graves.exists():
            return rows
        gone = graves.read()
        if besides is not None:
            gone = gone.filter(F.col("batch") != besides)
        gone = gone.select(self.key, F.col("of_batch").alias("batch"))
        return null_safe_join(rows, gone, [self.key, "batch"], "left_anti")

    def live_holding(self, ids: DataFrame) -> DataFrame:
        """Live rows that may hold one of the staged ids."""
        return self.live(within=self.holding(ids))

    def delete(self, ids: DataFrame, deletion: str) -> None:
        """Delete all rows of some ids, under the name of the deletion."""
        with Staging(self.spark) as staging:
            doomed = staging.put(ids.select(self.key).distinct(), "doomed")
            held = self.live(deletion, self.holding(doomed))
            found = null_safe_join(held, doomed, [self.key], "left_semi")
            graves = found.select(self.key, F.col("batch").alias("of_batch")).distinct()
            self.tombstones().write(staging.put(graves, "graves"), deletion)

    def compacted_into(self, target: str, rows: DataFrame, batch: str) -> None:
        """Write some rows as the only batch of a new table of the same kind, sorted by key."""
        type(self)(self.spark, target, self.buckets).write(rows, batch)


class PredictionLog(DeletableTable):
    """The log, partitioned by the day of the prediction for pruned window scans.

    Days and buckets of ids are folders, so that windows and ids are found without the rest.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        super().__init__(spark, path, PREDICTION_SCHEMA, "predicted_date", buckets=buckets)

    def _of_others(self, batch: str) -> Callable[[DataFrame], DataFrame]:
        """By staged ids, the live rows of other batches that may hold one of them."""
        return lambda ids: self.live_holding(ids).filter(F.col("batch") != batch)

    def unlogged(self, staged: DataFrame, batch: str) -> DataFrame:
        """The staged rows whose id is not logged by another batch yet."""
        return unlogged(self._of_others(batch), staged, self.key)

    def append(self, df: DataFrame, batch: str) -> None:
        """Append the rows whose id is not logged by another batch yet."""
        day = utc_day("predicted_at")
        if not self.exists():  # nothing to compare with, and nothing that is read while replaced
            fresh = first_per_key(df, self.key, ["predicted_at"])
            self.write(fresh.withColumn("predicted_date", day), batch)
            return
        with Staging(self.spark) as staging:
            fresh = new_predictions(self._of_others(batch), df, stage=staging.put)
            self.write(staging.put(fresh.withColumn("predicted_date", day), "fresh"), batch)

    def compact(self, target: str, batch: str) -> PredictionLog:
        """The live rows as a new log of one batch; readers switch to it when it is complete."""
        self.compacted_into(target, self.live(), batch)
        return PredictionLog(self.spark, target, self.buckets)


class LabelStore(DeletableTable):
    """Accepted labels per batch; the newest batch of an id counts.

    A correction appends a row instead of rewriting the table, so a micro-batch costs what
    it carries. ``compact`` folds everything into one batch from time to time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        super().__init__(spark, path, LABEL_SCHEMA, buckets=buckets)

    def current(self) -> DataFrame:
        rows = latest_per_key(self.live(), "prediction_id", ["batch", "labeled_at"])
        return rows.select(*LABEL_COLUMNS)

    def upsert(self, predictions: Log | PredictionLog, df: DataFrame, batch: str) -> DataFrame:
        """Store the labels of known predictions; returns the others with their ids.

        Of a PredictionLog only the buckets of the labelled ids are read.
        """
        if isinstance(predictions, PredictionLog):
            predictions = predictions.live_holding
        matched = matched_labels(predictions, df)
        self.write(matched.filter("known"), batch)
        return matched.filter("NOT known").select(*df.columns)

    def compact(self, target: str, batch: str) -> LabelStore:
        """The current labels as a new store; readers switch to it when it is complete."""
        self.compacted_into(target, self.current(), batch)
        return LabelStore(self.spark, target, self.buckets)


def purge(log: PredictionLog, labels: LabelStore, doomed: Column, deletion: str) -> None:
    """Delete the doomed predictions of the stores and, with them, their labels.

    Run again under the same name it changes nothing, also if it stopped half-way: labels go
    first, and the predictions that lead to them are there until those are gone.
    """
    with Staging(log.spark) as staging:
        ids = log.live(deletion).filter(F.coalesce(doomed, F.lit(False))).select("prediction_id")
        ids = staging.put(ids.distinct(), "doomed")
        labels.delete(ids, deletion)
        log.delete(ids, deletion)


class ProfileStore(BatchTable):
    """Reference profiles, one batch per model version."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, PROFILE_SCHEMA)

    def write_profile(self, profile: DataFrame, model_version: str) -> None:
        rows = profile.withColumn("model_version", F.lit(str(model_version)))
        self.write(rows, f"version-{model_version}")

    def read_profile(self, model_version: str) -> DataFrame:
        return self.read().filter(F.col("batch") == f"version-{model_version}").drop("batch")


class PerformanceStore(BatchTable):
    """Scores of runs on their test rows, one batch per run; what promotion compares."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, PERFORMANCE_SCHEMA)

    def write_performance(self, run_id: str, performance: dict[str, float]) -> None:
        row = (
            run_id,
            float(performance["f1_weighted"]),
            float(performance["accuracy"]),
            int(performance["n_eval"]),
        )
        self.write(self.spark.createDataFrame([row], PERFORMANCE_SCHEMA), f"run-{run_id}")


class SummaryStore(BatchTable):
    """Moments of the logged inputs per version and day, one batch per day."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, SUMMARY_SCHEMA, "day")


class RunStore(BatchTable):
    """Facts of runs and checks in long form."""

    def __init__(self, spark: SparkSession, path: str):
        super().__init__(spark, path, RUN_SCHEMA)

    def log(self, facts: DataFrame, run_id: str) -> None:
        self.write(facts, f"run-{run_id}")


def profile_json(
    profile: DataFrame, created_at: str, performance: dict[str, float] | None = None
) -> DataFrame:
    """One JSON document of a profile: features by name, keys sorted."""
    numeric = F.map_from_entries(
        F.sort_array(
            F.collect_list(
                F.struct("feature", F.struct("mean", "missing_rate", "std").alias("baseline"))
            )
        )
    )
    scores = F.lit(None)
    if performance is not None:
        scores = F.struct(
            F.lit(float(performance["accuracy"])).alias("accuracy"),
            F.lit(float(performance["f1_weighted"])).alias("f1_weighted"),
            F.lit(int(performance["n_eval"])).alias("n_eval"),
        )
    document = F.struct(
        F.lit(created_at).alias("created_at"),
        F.max("n_rows").alias("n_rows"),
        numeric.alias("numeric"),
        scores.alias("performance"),
    )
    return profile.agg(F.to_json(document, {"ignoreNullFields": "false"}).alias("profile"))


# The JSON layout of a profile.
PROFILE_JSON = (
    "created_at string, n_rows bigint, "
    "numeric map<string, struct<mean: double, missing_rate: double, std: double>>, "
    "performance struct<accuracy: double, f1_weighted: double, n_eval: bigint>"
)


def parse_profile_json(df: DataFrame, json_col: str = "profile") -> DataFrame:
    """(feature, mean, std, missing_rate, n_rows) from JSON documents, other columns kept."""
    keys = [c for c in df.columns if c != json_col]
    parsed = df.withColumn(json_col, F.from_json(json_col, PROFILE_JSON))
    return parsed.select(
        *keys, F.col(f"{json_col}.n_rows").alias("n_rows"), F.explode(f"{json_col}.numeric")
    ).select(
        *keys, F.col("key").alias("feature"), "value.mean", "value.std", "value.missing_rate",
        "n_rows",
    )
