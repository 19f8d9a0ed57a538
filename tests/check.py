"""Run registered queries against their checking SQL in DuckDB.

    python tests/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool):
        return str(v)
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=lambda r: tuple(map(str, r)))


def compare(name, df, con, sql):
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    want = rows_of(want_names, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(want_names):
        return f"columns {sorted(df.columns)} != {sorted(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, e.g. spark {bad[0][0]} sql {bad[0][1]}"
    return None


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    import __spark_entry__ as e
    from replyloom.session import local_session

    spark = local_session("8")
    con = connect(args.sf)
    checks, failed = e.oracle_sql(), []
    for name, fn in e.queries().items():
        if args.names and name not in args.names:
            continue
        start = time.perf_counter()
        try:
            df = fn(spark, args.sf)
            if name in checks:
                problem = compare(name, df, con, checks[name])
                n = "checked"
            else:
                n, problem = f"{df.count()} rows only", None
        except Exception as ex:  # report and go on
            problem = f"{type(ex).__name__}: {str(ex)[:1500]}"
            n = "error"
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {time.perf_counter() - start:6.2f}s {n if not problem else problem}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    return bool(failed)


if __name__ == "__main__":
    sys.exit(main())
