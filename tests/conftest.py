import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from helixtab.workspace import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("HELIXTAB_SHUFFLE", "4")
    os.environ.setdefault("HELIXTAB_DRIVER_MEM", "6g")
    session = build_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Treat every key with more than a few rows as heavy."""
    spark.conf.set("helixtab.maxGroupRows", "5")
    yield
    spark.conf.unset("helixtab.maxGroupRows")


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if not order else out
