"""Every registered training-data query over the smallest tables, with its SQL where there is one."""

import pytest

from foliospark.llm.queries import ORACLES, QUERIES
from testkit.check import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    good, message = compare(spark, SMALL, name, QUERIES[name], ORACLES.get(name), connect(SMALL))
    assert good, message


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
