"""Every named query on the smallest tables against its SQL."""

import os

import pytest
from oracle import check, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_entry(spark):
    out = entry(spark)
    assert out.count() > 0
    assert out.columns[0] == "label"


def test_names():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    check(spark, con, FOLDER, queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_query_without_sql(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0
