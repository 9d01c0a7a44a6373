"""Every query on the smallest tables: against SQL where there is a twin, else for rows."""

import os

import pytest

import __spark_entry__ as entry
from reviewlake.plans import QUERIES, SQL
from tests.oracle import compare, connect

BASE = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, BASE, QUERIES[name], SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, BASE).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())
