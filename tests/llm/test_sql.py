"""The queries that SQL can express against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from compare import check, connect

from cairn.llm import queries


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, con, name):
    check(spark, con, queries.QUERIES[name], queries.ORACLES[name])
