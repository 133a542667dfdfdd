"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from seriesmill.plans import all_queries

from .oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) < set(contract.queries())
    assert contract.entry(spark).count() > 0
