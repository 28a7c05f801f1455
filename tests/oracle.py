"""Side-by-side comparison of a query with its DuckDB oracle, as sorted rows with columns by name."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v if v is None or isinstance(v, (int, bool, str)) else str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)
