"""Named queries over the given tables, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfare.session import prepare, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


_kept: dict[tuple, object] = {}


def forget() -> None:
    """Make shared inputs anew from now on, so that a timing includes them."""
    _kept.clear()


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], object]) -> object:
    """Make something that several queries of a session share; ``make`` gets an unused path."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _kept:
        _kept[key] = make(scratch_path(spark, name))
    return _kept[key]
