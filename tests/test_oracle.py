"""Every registered query against its SQL in a second engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    pytest.importorskip("duckdb")
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, connection, name):
    df = contract.queries()[name](spark, sf_dir)
    assert difference(df, connection, contract.oracle_sql()[name]) is None
