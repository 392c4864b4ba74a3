"""Run a query and its SQL on the same tables and compare values."""

import math
from pathlib import Path

import duckdb


def connect(root):
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in Path(root).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def check(spark, con, root, name, query, sql):
    df = query(spark, root)
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    ran = con.execute(sql)
    want = _table([d[0] for d in ran.description], ran.fetchall())
    assert got[0] == want[0], name
    assert len(got[1]) == len(want[1]), name
    assert got[1] == want[1], name
