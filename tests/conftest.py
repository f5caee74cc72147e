import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import build_session  # noqa: E402
from sluice.sources.staging import Staging  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "sluice-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    with Staging(spark) as stage:
        yield stage


@pytest.fixture
def shuffled_joins(spark):
    """Joins may not fall back on broadcasting whole tables."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)
