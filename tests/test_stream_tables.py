"""Streams over tables that are folders of part files, as large tables are."""

import os
import shutil

import pytest

from driftline.plans import queries_stream, registry
from oracle import connect, difference


@pytest.fixture(scope="module")
def folders(spark, tables, tmp_path_factory):
    """The labels and events in several files, everything else as it is."""
    target = str(tmp_path_factory.mktemp("folders"))
    for name in os.listdir(tables):
        shutil.copyfile(f"{tables}/{name}", f"{target}/{name}")
    for name in ("labels", "events"):
        os.remove(f"{target}/{name}.parquet")
        rows = spark.read.parquet(f"{tables}/{name}.parquet")
        rows.repartition(3).write.parquet(f"{target}/{name}.parquet")
    return target


@pytest.mark.parametrize("name", ["stream_labels", "stream_log"])
def test_streams_read_tables_of_many_files(spark, tables, folders, name):
    query = getattr(queries_stream, name)
    sql = registry.ORACLES[name]
    assert query(spark, folders).count() > 0
    assert difference(query(spark, folders), sql, connect(tables)) is None
