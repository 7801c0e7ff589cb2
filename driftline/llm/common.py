"""Helpers of this package: tables, stages, code for workers, plain ASCII text rules."""

from __future__ import annotations

import string
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import scratch_path

#: ASCII white space: tab to carriage return, and the blank.
BLANK = r"[\x09-\x0D ]"
WORD = r"[^\x09-\x0D ]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(module: str) -> None:
    """Send the worker functions of a module by value, so that executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def worker_state(key: str, make: Callable[[], Any]) -> Any:
    """One object per Python worker process, kept between the tasks that the process runs."""
    holder = sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


#: Rows that a worker turns into Python objects at a time; an Arrow batch holds thousands.
SLICE_ROWS = 256


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches in short pieces, so that a worker holds few texts at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


class Stages:
    """Tables written once in the shared folder, so that lost executors lose nothing of them.

    ``drop`` deletes those that no later plan reads; what a returned frame still reads stays
    for the owner of the folder to expire.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(staged)] = path
        return staged

    def drop(self, *staged: DataFrame) -> None:
        context = self.spark.sparkContext
        for df in staged:
            path = context._jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(df)))
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole_text(column: str) -> Column:
    """Null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def ascii_lower_sql(expression: str) -> str:
    return f"translate({expression}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
