"""Every registered query of the library itself, and any other that has SQL, against it on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["conversation_id", "example"] and frame.count() == 13


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    frame = contract.queries()[name](spark, FOLDER)
    assert difference(frame, contract.oracle_sql()[name], connection) is None
