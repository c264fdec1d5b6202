"""Compare a Spark result with its SQL twin, column by column."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    return v


def _key(row):
    return tuple((v is None, str(type(v)), str(v)) for v in row)


def rows_of(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_norm(r[n]) for n in names) for r in df.collect()), key=_key)


def compare(query, sql, spark, sf_dir, con=None):
    """Returns (ok, message)."""
    con = con or connect(sf_dir)
    t = time.time()
    df = query(spark, sf_dir)
    names, got = rows_of(df)
    spent = time.time() - t
    if sql is None:
        return len(got) > 0, f"{len(got)} rows (no SQL) {spent:.1f}s"
    cur = con.execute(sql)
    have = [d[0] for d in cur.description]
    order = sorted(range(len(have)), key=lambda i: have[i])
    want = sorted((tuple(_norm(r[i]) for i in order) for r in cur.fetchall()), key=_key)
    if sorted(have) != names:
        return False, f"columns {names} != {sorted(have)}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}"
    for i, (g, w) in enumerate(zip(got, want)):
        if g != w:
            diff = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
            bad = sum(x != y for x, y in zip(got, want))
            return False, f"{bad} rows differ; row {i}: {diff[:6]}"
        if [type(x) for x in g] != [type(x) for x in w] and None not in g:
            return False, f"types differ: {[(n, type(a), type(b)) for n, a, b in zip(names, g, w) if type(a) is not type(b)]}"
    return len(got) > 0, f"{len(got)} rows {spent:.1f}s"
