"""Run registered queries against their DuckDB oracles (as the driver does).

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if v is pd.NaT:
        return "∅"
    if isinstance(v, pd.Timestamp):
        return v.tz_localize(None).isoformat() if v.tzinfo else v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def digest(df: pd.DataFrame) -> tuple[list[str], int, str]:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df[cols].astype(object).to_dict("records"))
    return cols, len(rows), hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, sf_dir: str, names=None):
    from __spark_entry__ import oracle_sql, queries

    qs, sql = queries(), oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t = time.time()
        try:
            sdf = qs[name](spark, sf_dir).toPandas()
            spark_s = time.time() - t
            odf = con.execute(sql[name]).df() if name in sql else None
            a = digest(sdf)
            if odf is None:
                results[name] = ("rows-only", a[1], spark_s)
                continue
            b = digest(odf)
            ok = a == b
            results[name] = ("OK" if ok else "MISMATCH", (a[:2], b[:2]), round(spark_s, 2))
        except Exception as e:  # noqa: BLE001
            results[name] = ("ERROR", repr(e)[:400], time.time() - t)
        print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    from mqtable.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf_dir, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    import json

    out = os.environ.get("COMPARE_OUT", "/tmp/oracle_compare.json")
    with open(out, "w") as fh:
        json.dump({k: [v[0], str(v[1]), v[2]] for k, v in res.items()}, fh, indent=1)
    print("FAILED:", bad)
