import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

import __spark_entry__  # noqa: E402, F401
from winnowmill.operators.scoring import RetryPolicy  # noqa: E402
from winnowmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", name="winnowmill-tests")
    yield session
    session.stop()


@pytest.fixture()
def no_wait():
    return RetryPolicy(sleep=lambda seconds: None)
