"""Run registered queries and their SQL on the same files and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_cell(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql):
    """None when both give the same rows, else a short description."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    expected = rows_of(names, theirs)
    if ours == expected:
        return None
    a, b = set(ours) - set(expected), set(expected) - set(ours)
    return f"{len(ours)} rows vs {len(expected)}; {len(a)} extra, {len(b)} missing\n  ours {sorted(a, key=repr)[:3]}\n  sql  {sorted(b, key=repr)[:3]}"
