"""Run a query in Spark and its SQL twin in DuckDB over the same tables, and compare."""

import math
import os

import duckdb
import numpy as np

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, (np.generic,)):
        return plain(v.item())
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return plain(v.asDict())
    if hasattr(v, "as_tuple"):
        return plain(float(v))
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def oracle(sql, sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    out = con.execute(sql)
    return rows([c[0] for c in out.description], out.fetchall())


def spark_rows(df):
    return rows(df.columns, df.collect())


def difference(df, sql, sf_dir):
    """None if equal, else a short text."""
    got, want = spark_rows(df), oracle(sql, sf_dir)
    if got[0] != want[0]:
        return f"columns {got[0]} / {want[0]}"
    if got[1] != want[1]:
        a, b = [x for x in got[1] if x not in set(want[1])], [x for x in want[1] if x not in set(got[1])]
        return f"rows {len(got[1])} / {len(want[1])}; columns {got[0]}; spark only {len(a)} {a[:2]}; oracle only {len(b)} {b[:2]}"
    return None
