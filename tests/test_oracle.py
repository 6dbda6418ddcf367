"""Every query with an oracle gives the oracle's rows."""

import pytest

import __spark_entry__ as entry_module
from cartflow.catalog import ORACLES, QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, oracle, name):
    assert differences(QUERIES[name](spark, sf_dir), oracle, ORACLES[name]) is None


def test_entry_and_contract(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
