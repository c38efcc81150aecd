"""Compare a registered query with its SQL on the same Parquet files."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: column names, or rows on either side. Empty when equal."""
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(names) ^ set(df.columns))}"]
    expected = _bag(names, cursor.fetchall())
    actual = _bag(df.columns, [tuple(row) for row in df.collect()])
    lines = [f"only in Spark: {row}" for row in list((actual - expected))[:3]]
    lines += [f"only in SQL:   {row}" for row in list((expected - actual))[:3]]
    types = _types(df.columns, actual), _types(names, expected)
    if types[0] != types[1]:
        lines.append(f"types {types}")
    return lines


def _types(names: list[str], bag: Counter) -> dict[str, set[type]]:
    return {
        name: {type(row[i]) for row in bag if row[i] is not None} for i, name in enumerate(sorted(names))
    }
