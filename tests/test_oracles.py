"""Every named query against its SQL, on the smallest given tables."""

from __future__ import annotations

import pytest
from compare import compare, open_tables
from conftest import SF_SMALL

import __spark_entry__ as entry_module
from gridledger.plans import build_oracles, build_queries

QUERIES = build_queries()
SQL = build_oracles()


@pytest.fixture(scope="module")
def tables():
    with open_tables(SF_SMALL) as con:
        yield con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, tables, name):
    compare(spark, tables, name, QUERIES[name], SQL[name], SF_SMALL)


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).count() > 0
