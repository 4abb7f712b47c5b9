"""Every query against its SQL twin, row by row, at the smallest scale."""

import pytest
from compare import difference, duck

from stockloom.catalog.oracle import oracle_sql
from stockloom.catalog.queries import queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["symbol", "peer_symbol", "peer_name", "market_cap", "rank"]
    assert df.limit(1).count() == 1
