"""Compares a query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from samples.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; empty where the results agree."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    out = [f"{n} is {k} against {kinds[n]}" for n, k in df.dtypes if same.get(k, k) != kinds[n]]
    theirs, ours = rows_of(names, found.fetchall()), rows_of(df.columns, df.collect())
    if theirs != ours:
        out.append(f"{sum(ours.values())} rows against {sum(theirs.values())}; "
                   f"only here {list((ours - theirs).items())[:3]}; only there {list((theirs - ours).items())[:3]}")
    return out
