from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from schoolyard.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from schoolyard.plans.workspace import Workspace

    return Workspace.over_star(spark, TESTDATA)


@pytest.fixture
def values(spark):
    """Results of column expressions over literal rows."""

    def run(rows, schema, **columns):
        df = spark.createDataFrame(rows, schema).select(
            *[c.alias(name) for name, c in columns.items()]
        )
        return [r[0] if len(columns) == 1 else tuple(r) for r in df.collect()]

    return run
