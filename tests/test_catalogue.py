"""Every query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from compare import check, connect

import __spark_entry__ as entry
from cairn.plans import catalogue


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    check(spark, con, catalogue.QUERIES[name], catalogue.ORACLES[name])


def test_every_query_has_sql():
    assert sorted(catalogue.QUERIES) == sorted(catalogue.ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["fname", "mid", "pairs", "size"]
