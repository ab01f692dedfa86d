import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session
    from editflow.session import configure

    started = configure(session("4"))
    yield started
    started.stop()


@pytest.fixture
def folder(spark):
    """New paths of the session's shared folder."""
    from editflow.session import scratch_path

    return lambda label: scratch_path(spark, label)
