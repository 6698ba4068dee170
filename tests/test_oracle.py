"""Every query against its SQL counterpart."""

import pytest
from compare import SF, compare, duck

import __spark_entry__ as entry
from ledgerloom.queries import QUERIES
from oracle.sql import oracle

SQL = oracle()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()
