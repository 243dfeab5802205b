"""Run registered queries and compare them with their SQL on the same tables."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def family(dtype) -> str:
    kind = getattr(dtype, "kind", "O")
    return {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time"}.get(kind, "object")


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if family(frame[c].dtype) == "object":
            frame[c] = frame[c].map(lambda v: "<null>" if v is None or v is pd.NA or (isinstance(v, float) and v != v) else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True) if len(frame.columns) else frame


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = {c: (family(got[c].dtype), family(want[c].dtype)) for c in got.columns}
    wrong = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if wrong and len(got):
        return f"types {wrong}"
    a, b = normal(got), normal(want)
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same[~same].index[0]
            return f"{(~same).sum()} values differ in {c}: {a.loc[i].to_dict()} != {b.loc[i].to_dict()}"
    return None


def check(spark, con, name, entry, sf_dir):
    start = time.time()
    got = entry.plan(spark, sf_dir).toPandas()
    seconds = time.time() - start
    if entry.sql is None:
        return (None if len(got) else "no rows"), len(got), seconds
    return difference(got, con.sql(entry.sql).df()), len(got), seconds


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from plumbline.plans import QUERIES
    from plumbline.session import local_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = local_session(8)
    con = connect(sf)
    bad = 0
    for name, entry in QUERIES.items():
        if wanted and not any(w in name or w == entry.covers or w in entry.plan.__module__ for w in wanted):
            continue
        try:
            problem, rows, seconds = check(spark, con, name, entry, sf)
        except Exception as e:  # report and go on
            problem, rows, seconds = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {entry.covers:10s} {name:28s} rows={rows} {seconds:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)
