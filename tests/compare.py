"""Spark rows against DuckDB rows, without order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or v.__class__.__name__ == "Decimal":
        return f"{float(v):.6f}"
    return str(v)


def duck(d):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    return c


def sides(df, con, sql):
    cols = sorted(df.columns)
    ours = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(sql)
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols, (sorted(names), cols)
    at = [names.index(c) for c in cols]
    theirs = sorted(tuple(norm(r[i]) for i in at) for r in cur.fetchall())
    return ours, theirs
