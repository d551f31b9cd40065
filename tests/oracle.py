"""Compare registered queries with their SQL on the same parquet files."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def same(left, right) -> str | None:
    """None when equal, else a short account of the first difference."""
    (lc, lr), (rc, rr) = left, right
    if lc != rc:
        return f"columns {lc} != {rc}"
    if len(lr) != len(rr):
        return f"{len(lr)} rows != {len(rr)} rows; e.g. {lr[:2]} / {rr[:2]}"
    for a, b in zip(lr, rr):
        for x, y in zip(a, b):
            if type(x) is not type(y) or x != y:
                return f"{a} != {b} (columns {lc})"
    return None
