"""Queries of this package, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wayfare.session import prepare, ship

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Arrow batches: a few hundred documents, so that a batch of very long ones stays small.
ARROW_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "400"}


def ready(spark: SparkSession, python: bool = True) -> SparkSession:
    """The session with the options that the operators of this package rely on, and, where they run
    Python on the executors, with the package there."""
    prepare(spark)
    if python:
        ship(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def query(name: str, sql: str | None = None, python: bool = True) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(ready(spark, python), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
