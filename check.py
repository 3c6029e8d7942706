"""Run every registered query against its checking SQL: python check.py [folder] [name ...]"""

import datetime
import math
import sys
import time

import duckdb

import queries as q
from ringside.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    spark = build_session("ringside-check")
    bad = 0
    for name, run in q.QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            got = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name not in q.ORACLES:
                print(f"{name}: rows only, {len(got)} rows, {took:.1f}s", flush=True)
                continue
            rel = con.execute(q.ORACLES[name])
            names = [c[0] for c in rel.description]
            want = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name}: ERROR {str(e)[:1500]}", flush=True)
            bad += 1
            continue
        if sorted(names) != sorted(df.columns):
            print(f"{name}: COLUMNS {set(names) ^ set(df.columns)}", flush=True)
            bad += 1
            continue
        a, b = rows_of(df.columns, got), rows_of(names, want)
        if a == b:
            print(f"{name}: ok, {len(a)} rows, spark {took:.1f}s, sql {time.time() - start - took:.1f}s", flush=True)
            continue
        bad += 1
        cols = sorted(names)
        extra, missing = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        print(f"{name}: MISMATCH spark {len(a)} sql {len(b)}; {len(extra)} vs {len(missing)}", flush=True)
        for x, y in list(zip(extra, missing))[:3]:
            print("   ", [(c, i, j) for c, i, j in zip(cols, x, y) if i != j][:6], x[:3], flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
