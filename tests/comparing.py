"""Run a registered query and its SQL over the same files and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

STAR_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in STAR_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    """Columns by name, rows as a sorted list of plain values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con, sql):
    cur = con.execute(sql)
    return table([d[0] for d in cur.description], cur.fetchall())


def difference(left, right, shown: int = 3) -> str:
    """Empty if both tables are equal, else what differs."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if left[1] == right[1]:
        return ""
    pairs = [(a, b) for a, b in zip(left[1], right[1]) if a != b][:shown]
    return f"{len(left[1])} rows != {len(right[1])} rows; {left[0]}\n" + "\n".join(
        f"  {a}\n  {b}" for a, b in pairs
    )
