"""Run a registered query and its DuckDB twin and compare rows.

`python -m tests.compare <sf or folder> [name ...]` prints what differs.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = "/root/testdata"
EXACT = bool(os.environ.get("COMPARE_EXACT"))  # else doubles count as equal at ten digits


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        raise TypeError("decimal left in a published column")
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0 if EXACT else float(f"{v:.10g}") + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql) -> str | None:
    """None if both sides agree, else a short text."""
    s_cols, s = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    d_cols, d = rows_of([c[0] for c in cur.description], cur.fetchall())
    if s_cols != d_cols:
        return f"columns: only spark {set(s_cols) - set(d_cols)}, only duckdb {set(d_cols) - set(s_cols)}"
    if s != d:
        a, b = list((s - d).elements()), list((d - s).elements())
        text = f"rows {sum(s.values())} vs {sum(d.values())}, {len(a)} and {len(b)} differ"
        for side, left in (("spark ", a), ("duckdb", b)):
            left.sort(key=str)
            for r in left[:2]:
                text += f"\n   {side} {dict(zip(s_cols, r))}"
        return text
    if not s:
        return "EMPTY on both sides"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    from martlet.session import local_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    folder = os.path.join(ROOT, sf)
    con = duck(folder)
    q, o = e.queries(), e.oracle_sql()
    bad = 0
    for name in names or q:
        start = time.time()
        try:
            df = q[name](spark, folder)
            if name in o:
                text = difference(df, con, o[name])
            else:
                text = f"(no oracle) {df.count()} rows"
        except Exception as ex:  # noqa: BLE001
            text = f"ERROR {str(ex)[:700]}"
        if text:
            bad += 1
            print(f"{name}: {text}", flush=True)
        took = time.time() - start
        if took > 8:
            print(f"   slow: {name} {took:.1f}s", flush=True)
    print(f"{len(names or q)} run, {bad} to look at")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
