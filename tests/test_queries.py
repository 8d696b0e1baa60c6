"""Every registered query beside its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from testkit.check import compare, connect

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    good, message = compare(spark, SMALL, name, QUERIES[name], ORACLES.get(name), con)
    assert good, message


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
