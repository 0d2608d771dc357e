from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermill.session import build_session  # noqa: E402

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="ordermill-tests", shuffle_partitions=8)
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ordermill-tests-"))
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """A fresh folder below the shared checkpoint root."""
    from ordermill.session import work_path

    return work_path(spark, "test")
