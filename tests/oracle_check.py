"""Compare every registered query with its DuckDB oracle (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if os.environ.get("STRICT_FLOATS") else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def frame_digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    from almacen.oracle import oracle_sql
    from almacen.queries import QUERIES

    con = duck(sf_dir)
    sqls = oracle_sql()
    results = {}
    for name in names or sorted(QUERIES):
        t = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols, sh, slines = frame_digest(df.columns, srows)
            if name not in sqls:
                results[name] = ("rows-only", len(srows))
                continue
            rel = con.execute(sqls[name])
            ocols_raw = [d[0] for d in rel.description]
            orows = rel.fetchall()
            ocols, oh, olines = frame_digest(ocols_raw, orows)
            ok = scols == ocols and sh == oh
            results[name] = ("ok" if ok else "MISMATCH", len(srows), len(orows))
            if not ok and verbose:
                print(f"  {name}: spark cols {scols}\n  {name}: duck  cols {ocols}")
                sset, oset = set(slines), set(olines)
                print("  only spark:", sorted(sset - oset)[:3])
                print("  only duck: ", sorted(oset - sset)[:3])
        except Exception as exc:  # noqa: BLE001
            results[name] = ("ERROR", repr(exc)[:300])
        if verbose:
            print(f"{name}: {results[name]} {time.time() - t:.1f}s", flush=True)
    return results


if __name__ == "__main__":
    from almacen.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    print("SUMMARY", len(res) - len(bad), "/", len(res), "ok;", "bad:", sorted(bad))
