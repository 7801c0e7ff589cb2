import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from driftline.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "driftline-tests",
        cpus=4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return "/root/testdata/sf0.001"
