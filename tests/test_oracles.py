"""Every query with a SQL twin, on the smallest sample."""

import pytest
from oracle import connect, differences

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(small):
    with connect(small) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, small, con, name):
    assert differences(queries()[name](spark, small), con, oracle_sql()[name]) == []


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert "target_3d" in entry(spark).columns
