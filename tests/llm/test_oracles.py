"""Queries that SQL can express, against their SQL twins, value by value."""

import pytest
from compare import difference, duck

from stockloom.llm import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_operator_has_a_query():
    numbers = {int(name[2:].split("_")[0]) for name in catalog.queries()}
    assert numbers == set(range(1, 14))
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_twin(spark, con, name):
    assert difference(catalog.queries()[name](spark, FOLDER), con, catalog.oracle_sql()[name]) is None
