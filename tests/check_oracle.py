"""Run queries next to their check SQL and compare rows exactly.

    python tests/check_oracle.py [--sf sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def norm(v):
    """Floats by their exact text, so that also -0.0 and 0.0 differ."""
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)), [names[i] for i in order]


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def compare(spark, con, name, query, sql, folder):
    t0 = time.time()
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if sql is None:
        return f"rows={len(got)} (no SQL)", took, len(got) > 0
    t0 = time.time()
    rel = con.sql(sql)
    want = rel.fetchall()
    sql_took = time.time() - t0
    a, an = rows_of(df.columns, got)
    b, bn = rows_of(rel.columns, want)
    if an != bn:
        return f"columns {an} != {bn}", took, False
    types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    bad = [(c, t, types[c]) for c, t in df.dtypes if KINDS.get(t) != types[c]]
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", took, False
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return f"{len(diff)} of {len(a)} rows differ: {an}\n   spark {diff[0][0]}\n   sql   {diff[0][1]}", took, False
    if bad:
        return f"types {bad}", took, False
    return f"ok {len(a)} rows (sql {sql_took:.1f}s)" + ("" if a else " EMPTY"), took, bool(a)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from saleslens.registry import ORACLES, QUERIES
    from saleslens.session import build_session

    folder = f"/root/testdata/{args.sf}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="check-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    names = [n for n in QUERIES if not args.names or any(n.startswith(a) for a in args.names)]
    failed = []
    for n in names:
        try:
            text, took, ok = compare(spark, con, n, QUERIES[n], ORACLES.get(n), folder)
        except Exception as e:  # report and go on
            text, took, ok = f"{type(e).__name__}: {str(e)[:900]}", 0.0, False
        if not ok:
            failed.append(n)
        print(f"{'ok  ' if ok else 'FAIL'} {took:5.1f}s {n}: {text}", flush=True)
    print(f"{len(names) - len(failed)}/{len(names)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
