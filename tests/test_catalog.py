"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = driver.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert compare(df, con, ORACLES[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_queries_leave_no_view_or_table(spark):
    from millrace.catalog import REGISTRY

    for name in REGISTRY:
        if "sql" in name or "table" in name or "udtf" in name or "datagen" in name:
            REGISTRY[name].run(spark, SF_DIR)
    assert [t.name for t in spark.catalog.listTables()] == []
