"""Shared helpers: run a registered query and its DuckDB oracle, compare."""

import datetime as dt
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def rows_by_name(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    rel = con.sql(sql)
    orows, ocols = rel.fetchall(), rel.columns
    assert sorted(scols) == sorted(ocols), (scols, ocols)
    assert len(srows) == len(orows), (len(srows), len(orows))
    a, b = rows_by_name(srows, scols), rows_by_name(orows, ocols)
    assert a == b, (sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3])
    return len(srows)
