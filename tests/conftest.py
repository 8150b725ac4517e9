import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from larder.session import local_session, ship_package  # noqa: E402

os.environ.setdefault("LARDER_SHUFFLE_PARTITIONS", "4")
TESTDATA = Path(os.environ.get("LARDER_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="larder-tests-")
    session = local_session(os.environ.get("LARDER_TEST_CORES", "8"), "larder-tests", **{"spark.checkpoint.dir": folder})
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().toString()
