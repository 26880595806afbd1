import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__  # noqa: E402, F401  (registers how functions reach the workers)
from tidemark.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
