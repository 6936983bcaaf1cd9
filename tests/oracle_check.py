"""Compare every registered query with its DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Same idea as the driver's check: row count, column names, and an
order-insensitive comparison of the values (floats compared to 1e-9 relative).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name, query, sql, sf_dir):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_names = [c[0] for c in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(n.lower() for n in s_names) != sorted(n.lower() for n in d_names):
        problems.append(f"columns spark={s_names} duck={d_names}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        if diff:
            problems.append(f"{len(diff)} rows differ, first: spark={diff[0][0]} duck={diff[0][1]}")
    return problems, len(s_rows), t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from acctflow.session import build_session

    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            print(f"SKIP {name}: no oracle")
            continue
        try:
            problems, n, secs = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            problems, n, secs = [f"error {type(exc).__name__}: {str(exc)[:400]}"], -1, 0
        status = "OK  " if not problems else "FAIL"
        bad += bool(problems)
        print(f"{status} {name:28s} rows={n:7d} {secs:6.2f}s {'; '.join(problems)}", flush=True)
    print(f"{len(names or qs) - bad} ok, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
