"""Run a query and its oracle SQL on the same Parquet tables and compare rows."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(map(_norm, value))
    return value


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    cur = con.execute(sql)
    expected_cols = [c[0] for c in cur.description]
    expected_rows = cur.fetchall()
    if sorted(df.columns) != sorted(expected_cols):
        return f"columns {sorted(df.columns)} vs {sorted(expected_cols)}"
    cols = sorted(df.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    at = [expected_cols.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in at) for r in expected_rows)
    if got == want:
        return None
    missing, extra = list((want - got).items())[:3], list((got - want).items())[:3]
    return f"rows {sum(got.values())} vs {sum(want.values())} on {cols}; missing {missing}; extra {extra}"
