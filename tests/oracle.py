"""Compare a registered query with its SQL twin."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = rows_of(df.columns, df.collect())
    if got == want:
        return None
    only_got, only_want = got - want, want - got
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; only spark {sum(only_got.values())}: "
        f"{list(only_got)[:2]}; only sql {sum(only_want.values())}: {list(only_want)[:2]}"
    )
