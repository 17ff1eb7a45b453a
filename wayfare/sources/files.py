"""Batch tables: CSV and Parquet in, Parquet and CSV out."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def read_trips_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema: no pass over the data to guess types."""
    return spark.read.schema(schema).csv(path, header=True, escape='"')


def read_csv_strings(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """CSV with a header, every column text; types are guessed only on request."""
    return spark.read.csv(path, header=True, inferSchema=infer, escape='"')


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_or_default(spark: SparkSession, path: str, default: DataFrame) -> DataFrame:
    """The table at ``path``, or the default if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return default
        raise


def ensure_columns(df: DataFrame, names: list[str], value=0.0) -> DataFrame:
    """Add the missing ones of the named columns with a constant."""
    return df.withColumns({name: F.lit(value) for name in names if name not in df.columns})


def write_table(df: DataFrame, path: str, by: list[str] = (), gather: bool = False) -> None:
    """Overwrite a Parquet table; with ``by`` only the partitions that ``df`` holds.

    By default every task writes its rows where they belong, without a shuffle. ``gather`` brings a
    partition's rows together, so that many tasks do not leave many small files; how many tasks
    share a partition follows from its bytes, so a month that holds much of the data is split.
    """
    if by and gather:
        df = df.hint("rebalance", *[F.col(name) for name in by])
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """All rows, as CSV with a header."""
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def export_first_csv(df: DataFrame, path: str, limit: int, order: list[str]) -> None:
    """The first ``limit`` rows in a stated order, as CSV with a header. ``order`` should be total, else
    which of equal rows comes is left open."""
    export_csv(df.orderBy(*order).limit(limit), path)
