"""Run registered queries in both engines and compare the results; used by the tests and by hand.

    python tests/check.py [sf] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from riskmart.session import build_session, with_shared_folder  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def session(**conf):
    return with_shared_folder(build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__log__level="ERROR", **conf,
    ))


def _cell(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if v != v else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_cell(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(rows, key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    """(message, seconds): message is None when both engines agree."""
    t = time.time()
    df = fn(spark, sf_dir)
    got = df.collect()
    took = time.time() - t
    if sql is None:
        return (None if got else "no rows"), took, len(got)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]).lower() for d in cur.description}
    want_cols, want = rows_of(names, cur.fetchall())
    cols, rows = rows_of(df.columns, got)
    if cols != want_cols:
        return f"columns differ: {set(cols) ^ set(want_cols)}", took, len(got)
    same = {"integer": "int", "bigint": "bigint", "varchar": "string", "date": "date", "double": "double", "boolean": "boolean"}
    odd = {c: (t, types[c]) for c, t in df.dtypes if same.get(types[c], types[c]) != t}
    if len(rows) != len(want):
        return f"{len(rows)} rows, expected {len(want)}", took, len(got)
    diff = [(a, b) for a, b in zip(rows, want) if a != b]
    if diff:
        a, b = diff[0]
        where = [(c, x, y) for c, x, y in zip(cols, a, b) if x != y]
        return f"{len(diff)} rows differ, first: {where} in {a}", took, len(got)
    return (f"types differ: {odd}" if odd else None), took, len(got)


def main(argv):
    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    wanted = argv[1:] or list(qs)
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in wanted:
        try:
            message, took, n = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001  (a report line per query)
            message, took, n = f"{type(e).__name__}: {str(e)[:600]}", 0, 0
        bad += message is not None
        kind = "sql " if name in sqls else "rows"
        print(f"{'ok  ' if message is None else 'FAIL'} {kind} {name:28s} {n:7d} {took:6.2f}s {message or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
