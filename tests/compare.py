"""Run queries and their SQL side by side: ``python tests/compare.py [sf dir] [names...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first {got[:2]} / {want[:2]}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    types = {(type(x).__name__, type(y).__name__) for a, b in zip(got, want) for x, y in zip(a, b) if x is not None and type(x) is not type(y)}
    if bad:
        return f"{len(bad)} of {len(got)} rows differ; first {bad[0]}"
    if types:
        return f"types differ {types}"
    return None if got else "no rows"


def main():
    from gridspark import get_session
    from gridspark.workload import QUERIES, SQL

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            if name in SQL:
                problem = compare(df, con, SQL[name])
                n = ""
            else:
                n = f"{df.count()} rows only"
                problem = None
        except Exception as exc:  # noqa: BLE001
            problem, n = f"{type(exc).__name__}: {str(exc)[:600]}", ""
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - t:.2f}s {n} {problem or ''}"[:1200], flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
