import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from queuelens.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]",
        **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def zone(spark):
    """Sets the session time zone for one test."""
    name = "spark.sql.session.timeZone"
    before = spark.conf.get(name)
    yield lambda value: spark.conf.set(name, value)
    spark.conf.set(name, before)
