"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from conftest import SF_DIR
from oracle_check import compare, duck_connection

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "ProductName" and df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None
