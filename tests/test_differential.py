"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as entry
from eventlens.oracle import ORACLES
from eventlens.registry import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    compare(df, con, ORACLES[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_city", "total"]
