"""Run a registered query and its SQL, and compare the results value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET memory_limit = '4GB'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if value is None or isinstance(value, (int, str, bool)):
        return value
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(table, key=lambda r: [(v is None, type(v).__name__, v) for v in r])


def spark_result(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql):
    cursor = con.execute(sql)
    return canonical([d[0] for d in cursor.description], cursor.fetchall())


def differences(left, right, limit=3):
    """Human-readable differences, empty if the results are equal."""
    if left[0] != right[0]:
        return [f"columns {left[0]} != {right[0]}"]
    if len(left[1]) != len(right[1]):
        return [f"rows {len(left[1])} != {len(right[1])}", str(left[1][:2]), str(right[1][:2])]
    found = []
    for a, b in zip(left[1], right[1]):
        if a != b:
            found.append(
                "; ".join(
                    f"{c}: {x!r} != {y!r}" for c, x, y in zip(left[0], a, b) if x != y
                )
            )
    return found[:limit] + ([f"... {len(found)} rows differ"] if len(found) > limit else [])
