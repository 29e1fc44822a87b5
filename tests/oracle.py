"""Compares a query's rows with those of its SQL in DuckDB, as sets with counts and by column name."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v: object) -> object:
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def duck(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if glob.glob(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def differences(df, sf_dir: str, sql: str) -> str:
    """Empty if both give the same rows."""
    (a, x), (b, y) = spark_rows(df), duck(sf_dir, sql)
    if a != b:
        return f"columns {a} and {b}"
    if x == y:
        return ""
    return f"{sum((x - y).values())} rows only here, as {list((x - y))[:2]}; {sum((y - x).values())} only there, as {list((y - x))[:2]}; {sum(x.values())} rows"
