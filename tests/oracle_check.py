"""Compare every registered query with its DuckDB SQL twin.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query: name, ok/FAIL, rows, reason.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

VIEWS = ("region nation customer supplier part orders lineitem events documents embeddings "
         "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in VIEWS:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
                 "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    t2 = time.time()
    reasons = []
    if sorted(s_cols) != sorted(d_cols):
        reasons.append(f"columns spark={s_cols} duck={d_cols}")
    else:
        st = dict(zip(s_cols, s_types))
        dt_ = dict(zip(d_cols, d_types))
        bad = [c for c in s_cols if SPARK_TO_DUCK.get(st[c], st[c]) != dt_[c]]
        if bad:
            reasons.append("types " + ", ".join(f"{c}: {st[c]} vs {dt_[c]}" for c in bad))
    if len(s_rows) != len(d_rows):
        reasons.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    elif not reasons:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            reasons.append(f"values differ, e.g. {diff}")
    return (not reasons, len(s_rows), t1 - t0, t2 - t1, "; ".join(reasons))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from __spark_entry__ import oracle_sql, queries
    from visitflow.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            n = fn(spark, sf_dir).count()
            print(f"{name:32s} rows-only  rows={n}", flush=True)
            continue
        try:
            ok, n, ts, td, why = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, ts, td, why = False, -1, 0, 0, f"error {type(e).__name__}: {str(e)[:400]}"
        failed += not ok
        print(f"{name:32s} {'ok  ' if ok else 'FAIL'} rows={n:<7d} spark={ts:5.1f}s duck={td:4.1f}s {why}",
              flush=True)
    print(f"failed={failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
