"""Compare a query with its SQL on the same tables, row by row, in any order."""

from __future__ import annotations

import glob
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f'CREATE VIEW "{name}" AS SELECT * FROM read_parquet(\'{path}\')')
    return con


def normal(value):
    if isinstance(value, (bytearray, memoryview)):
        return bytes(value)
    if isinstance(value, Decimal):
        return ("n", format(value.normalize(), "f"))
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return ("f", round(value, 9))
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    got, want = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    if got == want:
        return []
    got_set, want_set = set(map(repr, got)), set(map(repr, want))
    return [
        f"rows {len(got)} vs {len(want)}",
        f"only in result: {sorted(got_set - want_set)[:3]}",
        f"only in SQL: {sorted(want_set - got_set)[:3]}",
    ]
