"""Every checked query equals its SQL on the test tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.01"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert differences(queries()[name](spark, FOLDER), duck, SQL[name]) == []


def test_entry(spark):
    assert entry(spark).count() == 5
