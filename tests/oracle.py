"""Side by side comparison of a query and its DuckDB text, as multisets of rows."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return x


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p / '*.parquet' if p.is_dir() else p}'")
    return con


def differences(df, sql: str, sf_dir: str) -> tuple[int, int, list, list]:
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    rel = duck(sf_dir).execute(sql)
    columns = [d[0] for d in rel.description]
    assert sorted(columns) == names, (sorted(columns), names)
    at = [columns.index(c) for c in names]
    want = Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    return sum(got.values()), sum(want.values()), list((got - want).items())[:3], list((want - got).items())[:3]
