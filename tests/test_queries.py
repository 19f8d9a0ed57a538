"""Every registered query against its checking SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as e
from check import compare, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(e.queries()))
def test_query(spark, con, name):
    df = e.queries()[name](spark, SF)
    sql = e.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(name, df, con, sql) is None


def test_entry(spark):
    assert {r.run_id for r in e.entry(spark).collect()} == {"cheap", "strong", "router", "micro"}
