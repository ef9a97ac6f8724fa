"""Side-by-side check of registered queries against their DuckDB oracle SQL.

Usage: ``python -m palimpsest.plans.check [sf_dir] [name ...]``. Compares row counts,
column names and the order-insensitive multiset of rows (doubles rounded).
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

from ..session import TABLES, local_session
from .registry import all_queries


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    rows = df.collect()
    t_spark = time.time() - t0
    cols = df.columns
    res = {"name": name, "rows": len(rows), "spark_s": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    res["duck_s"] = round(time.time() - t0, 2)
    res["oracle_rows"] = len(orows)
    if sorted(cols) != sorted(ocols):
        res["status"] = f"schema mismatch {sorted(cols)} vs {sorted(ocols)}"
        return res
    idx = [ocols.index(c) for c in cols]
    a = Counter(tuple(_norm(r[i]) for i in range(len(cols))) for r in rows)
    b = Counter(tuple(_norm(r[i]) for i in idx) for r in orows)
    if a == b:
        res["status"] = "match"
    else:
        only_a = list((a - b).elements())[:2]
        only_b = list((b - a).elements())[:2]
        res["status"] = "value mismatch"
        res["spark_only"] = [str(x)[:300] for x in only_a]
        res["oracle_only"] = [str(x)[:300] for x in only_b]
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for name, (fn, sql) in all_queries().items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "status": f"error {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("match", "rows-only")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
