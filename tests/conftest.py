import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tablesync import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        os.environ.get("TEST_CPUS", "4"),
        **{
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
            "spark.checkpoint.dir": str(shared / "checkpoints"),
            "spark.sql.catalogImplementation": "in-memory",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
