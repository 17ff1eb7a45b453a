"""Every query with checking SQL gives the same columns, types and rows as DuckDB."""

from __future__ import annotations

import os

import pytest

import oracle
from wayfare.llm import queries

SF_DIR = os.environ.get("WAYFARE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    assert oracle.differences(queries.QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), queries.ORACLE[name]) == []
