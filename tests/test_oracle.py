"""Every registered query against its SQL twin, value by value."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from harness import compare, oracle

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return oracle(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, con, name):
    assert compare(QUERIES[name](spark, folder), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).columns


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
