"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, int):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, sql: str, con) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    expected = _rows(names, result.fetchall())
    got = _rows(df.columns, df.collect())
    if len(got) != len(expected):
        return f"{len(got)} rows against {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}"
    if not got:
        return "no rows"
    types = {n: (g, e) for n, g, e in zip(sorted(names), got[0], expected[0]) if type(g) is not type(e) and g is not None and e is not None}
    return f"types differ: {types}" if types else None
