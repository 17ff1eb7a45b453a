"""Compare a query's Spark result with its DuckDB result: columns, types, rows."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((value is None, str(type(value)) if value is None else "", repr(
        round(value, 6) if isinstance(value, float) else value)) for value in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def differences(df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} against {sorted(relation.columns)}"]
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    wrong = [f"type of {n}: {spark_types[n]} against {duck_types[n]}"
             for n in names if spark_types[n] != duck_types[n]]
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=_key)
    ours = sorted((tuple(r) for r in df.select(*names).collect()), key=_key)
    if len(ours) != len(theirs):
        return wrong + [f"{len(ours)} rows against {len(theirs)}"]
    unlike = [(a, b) for a, b in zip(ours, theirs)
              if not all(_same(x, y) for x, y in zip(a, b))]
    exact = sum(a != b for a, b in zip(ours, theirs))
    if unlike:
        wrong.append(f"{len(unlike)} of {len(ours)} rows differ, e.g. {unlike[0]}")
    elif exact:
        wrong.append(f"last digits differ in {exact} of {len(ours)} rows")
    if not ours:
        wrong.append("no rows")
    return wrong
