"""Run registered Spark queries and their DuckDB twins side by side.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row count, column names (sorted) and an order-insensitive hash of
values, like the driver's correctness gate, and prints the first differences.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and getattr(v, "ndim", 1) == 0:
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        return int(v) if v.is_integer() else v
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=repr)


def digest(rows: list[tuple]) -> str:
    h = hashlib.sha256()
    for r in rows:
        h.update(repr(r).encode())
    return h.hexdigest()[:16]


def compare(spark, con, name, fn, sql, sf_dir, verbose=True):
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(sdf), "spark_s": round(t1 - t0, 2), "status": "rows-only"}
    ddf = con.execute(sql).df()
    t2 = time.time()
    res = {"name": name, "spark_rows": len(sdf), "duck_rows": len(ddf), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    if sorted(sdf.columns) != sorted(ddf.columns):
        res["status"] = "SCHEMA"
        res["detail"] = f"spark-only {sorted(set(sdf.columns) - set(ddf.columns))} duck-only {sorted(set(ddf.columns) - set(sdf.columns))}"
        return res
    a, b = rows_of(sdf), rows_of(ddf)
    if len(a) != len(b):
        res["status"] = "ROWCOUNT"
        return res
    if digest(a) == digest(b):
        res["status"] = "OK"
        return res
    res["status"] = "VALUES"
    cols = sorted(sdf.columns)
    diffs = []
    for ra, rb in zip(a, b):
        if ra != rb:
            d = [(c, x, y) for c, x, y in zip(cols, ra, rb) if x != y]
            diffs.append(d[:4])
            if len(diffs) >= 3:
                break
    res["detail"] = diffs
    return res


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from yieldlens.session import local_session

    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")]
    spark = local_session(8)
    con = duck(sf_dir)
    qs, sq = queries(), oracle_sql()
    names = names or list(qs)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sq.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": "ERROR", "detail": repr(e)[:600]}
        if r["status"] not in ("OK", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
