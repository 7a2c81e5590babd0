"""Spark results against DuckDB on the same tables."""

import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder):
    duck = duckdb.connect()
    duck.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return duck


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return repr(v)


def differences(df, duck, sql):
    """None, or what differs."""
    cur = duck.execute(sql)
    names = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    order = sorted(names)
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in want)
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows; only here {sorted(set(got) - set(want))[:2]}, only in SQL {sorted(set(want) - set(got))[:2]}"
    return next((f"{order}: {a} and {b}" for a, b in zip(got, want, strict=True) if a != b), None)
