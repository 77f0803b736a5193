import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tellerbook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "2"})
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def other_zone(spark):
    """A session zone far from UTC."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)
