from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from costloom.session import get_spark

    session = get_spark(
        "costloom-tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    """A new folder per test."""
    return tempfile.mkdtemp(prefix="costloom-test-")
