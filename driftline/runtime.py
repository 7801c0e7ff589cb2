"""Session, shared folder and size-checked small sides."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows up to which a per-class / per-version / per-feature table is held by the
# driver and broadcast. Beyond it the table stays distributed and is joined plainly.
SMALL_SIDE_ROWS = 20_000
# And up to which size of its Arrow form, since rows may be wide.
SMALL_SIDE_BYTES = 16 << 20

# Temporary folders of local sessions, by application.
_LOCAL_DIRS: dict[str, str] = {}


def local_session(app: str = "driftline", cpus: str | int = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; on a cluster the caller brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir.

    Where it is unset, a temporary folder serves a local master, whose executors are this
    process; on a cluster they would not see it, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="driftline-")
    return _LOCAL_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Bytes of code up to which the JVM compiles a method; a longer one is interpreted for ever.
COMPILED_BYTES = 8_000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs of the block run wide projections in pieces that the JVM compiles.

    Spark fuses a stage into one method of up to 65,535 bytes, which for dozens of derived columns
    is beyond what the JVM compiles. A limit of the session that is low enough stays as it is.
    """
    before = spark.conf.get(_METHOD_LIMIT)
    if int(before) <= COMPILED_BYTES:
        yield
        return
    spark.conf.set(_METHOD_LIMIT, str(COMPILED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_METHOD_LIMIT, before)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANUP_LOCK = threading.Lock()
#: By session: how many blocks hold the setting, and what it was before.
_CLEANUP_HELD: dict[str, tuple[int, str]] = {}


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries of the block delete their shuffle files when they end, not when the driver collects garbage.

    For plans that run once, as those of writes do; a plan run again computes its shuffles anew.
    """
    key = spark._jsparkSession.sessionUUID()
    with _CLEANUP_LOCK:
        held, before = _CLEANUP_HELD.get(key, (0, ""))
        if not held:
            before = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _CLEANUP_HELD[key] = held + 1, before
    try:
        yield
    finally:
        with _CLEANUP_LOCK:
            held, before = _CLEANUP_HELD.pop(key)
            if held > 1:
                _CLEANUP_HELD[key] = held - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet in the shared folder and read back.

    Cuts lineage and keeps column pruning and pushdown for the passes that follow;
    the files survive the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    with compiled_methods(df.sparkSession), dropped_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


class Staging:
    """Staged tables with an owner: all are deleted when the ``with`` block ends.

    For jobs that have written their results by then; a frame that still reads a staged table
    must not leave the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.clear()

    def clear(self) -> None:
        context = self.spark.sparkContext
        for name in self.paths:
            path = context._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
        self.paths.clear()

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        with compiled_methods(self.spark), dropped_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class SmallSide:
    """A join side after its size was checked: broadcastable, or too large for that."""

    df: DataFrame
    rows: pa.Table | None

    @property
    def is_small(self) -> bool:
        return self.rows is not None


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with nulls allowed inside: Arrow refuses a null struct of required fields."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    return kind


def small_side(df: DataFrame, max_rows: int = SMALL_SIDE_ROWS) -> SmallSide:
    """Evaluate a table expected to be tiny; broadcast it only if it really is.

    At most ``max_rows + 1`` rows reach the driver. A table of more rows or bytes is staged
    and returned unhinted, so that the join falls back to Spark's own choice.
    """
    df = df.select(
        *[F.col(f"`{f.name}`").cast(_nullable(f.dataType)).alias(f.name) for f in df.schema.fields]
    )
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > SMALL_SIDE_BYTES:
        return SmallSide(stage_table(df, "side"), None)
    local = df.sparkSession.createDataFrame(rows, df.schema)
    return SmallSide(F.broadcast(local), rows)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys where null matches null; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({key: f"__r_{key}" for key in keys})
    condition = reduce(
        Column.__and__, [F.col(key).eqNullSafe(F.col(f"__r_{key}")) for key in keys]
    )
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{key}" for key in keys])
