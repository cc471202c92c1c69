"""Run a query and its SQL oracle and compare the rows.

Usage: python tests/compare.py [sf] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, Decimal)):
        f = float(v)
        if math.isnan(f):
            return "NaN"
        return "0" if f == 0 else f"{f:.12g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return f"{v:.12g}" if isinstance(v, int) and abs(v) < 10**12 else str(v)


def differences(df, con, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    cols = sorted(df.columns)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    order = [names.index(c) for c in cols]
    kinds = {c: str(df.schema[c].dataType) for c in cols}
    theirs = sorted(tuple(cell(r[i]) for i in order) for r in found.fetchall())
    ours = sorted(tuple(cell(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if any("Decimal" in k for k in kinds.values()):
        return f"decimal column in the output: {kinds}"
    return f"{len(bad)} of {len(ours)} rows differ, columns {cols}, first {bad[0]}" if bad else None


def main() -> None:
    from statewatt.catalog import ORACLES, QUERIES
    from statewatt.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    con = duck(f"{TESTDATA}/sf{sf}")
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, f"{TESTDATA}/sf{sf}")
            if name in ORACLES:
                problem = differences(df, con, ORACLES[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name:32s} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
