"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_point
from tideferry.queries import ORACLE, QUERIES
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    found = difference(QUERIES[name](spark, FOLDER), tables, ORACLE[name])
    assert found is None, found


def test_entry(spark):
    assert entry_point.entry(spark).count() == 10
