"""Every query with SQL gives the same rows as the SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, con, sf, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], sf) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
