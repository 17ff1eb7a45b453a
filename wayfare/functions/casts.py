"""Lenient conversions: a value that does not convert becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_long(text: Column) -> Column:
    """Integer text directly (keeps all digits), decimal text by truncation."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def to_int(text: Column) -> Column:
    return to_long(text).try_cast("int")


def first_present(names: list[str], available: list[str], default) -> Column:
    """The first non-null of several columns, else a constant."""
    found = [F.col(name) for name in names if name in available]
    return F.coalesce(*found, F.lit(default))
