"""Run registered queries in Spark and their SQL oracles in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name-prefix ...]
Prints one line per query and a summary; exit code 1 on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if hasattr(v, "asDict"):
        return tuple(sorted((k, norm(x)) for k, x in v.asDict().items()))
    if isinstance(v, dict):
        return tuple((str(k), norm(x)) for k, x in v.items())  # maps are compared with their entry order
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return v


def key(t):
    return repr(t)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    rows = rel.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=key)


def duck_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols, s_rows = spark_rows(df)
    t1 = time.time()
    if sql is None:
        return "rows-only", f"{len(s_rows)} rows", t1 - t0
    d_cols, d_rows = duck_rows(con, sql)
    if s_cols != d_cols:
        return "MISMATCH", f"columns spark={s_cols} duck={d_cols}", t1 - t0
    if len(s_rows) != len(d_rows):
        return "MISMATCH", f"rows spark={len(s_rows)} duck={len(d_rows)}", t1 - t0
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return "MISMATCH", f"first diff spark={a} duck={b}", t1 - t0
    return "ok", f"{len(s_rows)} rows", t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in argv[1:] if not a.startswith("/")]
    from evseq.plans import learned  # noqa: F401
    from evseq.plans.catalog import ORACLE, QUERIES
    from evseq.session import local_session

    spark = local_session()
    con = duck_connection(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            status, info, secs = compare(spark, con, name, fn, ORACLE.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            status, info, secs = "ERROR", f"{type(e).__name__}: {str(e)[:400]}", 0.0
        if status not in ("ok", "rows-only"):
            bad += 1
        print(f"{status:10s} {name:34s} {secs:6.2f}s {info}", flush=True)
    print(f"done: {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
