"""Run registered queries against DuckDB on the same tables and compare whole results."""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return float(v) if v % 1 else int(v)
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def compare(spark, con, sf, query, sql):
    df = query(spark, sf)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    return got, want


def main(sf, names):
    import __spark_entry__ as entry
    from netsift import local_session

    spark, con = local_session(cores="8"), duck(sf)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        begin = time.time()
        try:
            if name not in sqls:
                n = queries[name](spark, sf).count()
                print(f"{name:34} rows only {n:8} {time.time() - begin:6.1f}s", flush=True)
                continue
            got, want = compare(spark, con, sf, queries[name], sqls[name])
            ok = got == want and [type(v) for v in got[1][:1]] == [type(v) for v in want[1][:1]]
            print(f"{name:34} {'ok ' if ok else 'BAD'} {len(got[1]):8} {time.time() - begin:6.1f}s"
                  f"{'' if got[1] else '  EMPTY'}", flush=True)
            if not ok:
                bad += 1
                print("  columns", got[0], want[0])
                print("  rows", len(got[1]), len(want[1]))
                g, w = set(map(repr, got[1])), set(map(repr, want[1]))
                print("  only spark ", sorted(g - w)[:3])
                print("  only duckdb", sorted(w - g)[:3])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:34} ERROR {str(e)[:1500]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.path.insert(0, ".")
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
