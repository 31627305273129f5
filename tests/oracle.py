"""Run a registered query beside its SQL and compare the rows."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return float(repr(value))
    if hasattr(value, "as_tuple"):
        return float(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def compare(df, con, sql):
    """Return None when both sides agree, else a short text."""
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows_of(columns, cur.fetchall())
    loose = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    odd = [f"{c}: {t} / {types[c]}" for c, t in df.dtypes if loose.get(types[c], t) != t]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; {got[:1]} / {want[:1]}"
    for a, b in zip(got, want):
        if a != b:
            return f"columns {sorted(columns)}\n  spark {str(a)[:600]}\n  sql   {str(b)[:600]}"
    if odd:
        return f"types differ: {odd}"
    return None
