from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, connect

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert entry.entry(spark).count() == 100


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
