"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
import checks.queries
import checks.sql
from checks.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
# The queries of the other subpackage have tests of their own.
QUERIES = {name: query for name, query in contract.queries().items() if name in checks.queries.QUERIES}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name in checks.sql.ORACLES}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["metric", "value"] and df.count() == 2
