"""Every query with checking SQL gives the same columns, types and rows as DuckDB."""

from __future__ import annotations

import os

import pytest

import oracle
from wayfare.plans import catalog

SF_DIR = os.environ.get("WAYFARE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, con, name):
    assert oracle.differences(
        catalog.QUERIES[name](spark, SF_DIR), con, catalog.ORACLE[name]) == []


def test_every_oracle_has_a_query():
    assert catalog.ORACLE.keys() <= catalog.QUERIES.keys()
