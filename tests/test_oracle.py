"""Every registered query against its independent SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry
from tests.compare import differences, oracle_connection

SF = "/root/testdata/sf0.01"
QUERIES = registry.claims_queries()
ORACLE = registry.claims_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_equals_oracle(spark, connection, key):
    rows, difference = differences(QUERIES[key](spark, SF), connection, ORACLE[key])
    assert not difference
    assert rows > 0


def test_entry_returns_rows(spark):
    assert registry.entry(spark).limit(1).count() == 1
