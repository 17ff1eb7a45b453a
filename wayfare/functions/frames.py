"""Small frame helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are costly to compute and used by more than one later step.

    The optimizer copies the expression of a plain column into every condition it pushes down.
    A column that comes out of a generator is an attribute, so it is computed once per row.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [name for name in df.columns if name not in columns]
    if len(kept) == len(df.columns):
        return df.select("*", F.inline(F.array(row)))
    fresh = {name: f"_new_{name}" for name in columns}
    renamed = F.struct(*[column.alias(fresh[name]) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(renamed))).select(*[
        F.col(fresh[name]).alias(name) if name in fresh else F.col(name)
        for name in [*df.columns, *[name for name in columns if name not in df.columns]]])


def complete(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows whose named columns are all known (not null, not NaN).

    Unlike ``dropna`` the conditions are plain null tests, which reach a Parquet scan.
    """
    kinds = dict(df.dtypes)
    tests = [F.col(name).isNotNull() for name in names]
    tests += [~F.isnan(name) for name in names if kinds[name] in ("double", "float")]
    return df.filter(reduce(lambda a, b: a & b, tests))
