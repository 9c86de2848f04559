"""Queries against their SQL, and the registry."""

import pytest

from eventlens.llm.queries import ORACLES, QUERIES
from tests.oracle_compare import compare, duck

SMALL = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLES[name]) > 0
