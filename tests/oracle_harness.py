"""Compare a registered Spark query with its DuckDB oracle: row count,
column names and an order-insensitive hash of the values.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "\x00null"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, (_dt.date, _dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    hs = sorted(hashlib.md5("\x1f".join(_norm(r[i]) for i in order).encode()).hexdigest()
                for r in rows)
    return hashlib.md5("".join(hs).encode()).hexdigest()


def duck(sf_dir, sql):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(spark, name, sf_dir):
    from linemill.plans.catalog import ORACLE, QUERIES
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = {"name": name, "rows": len(rows), "spark_s": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["oracle"] = None
        return res
    ocols, orows = duck(sf_dir, ORACLE[name])
    res.update(oracle_rows=len(orows), duck_s=round(time.time() - t1, 2),
               cols_ok=sorted(cols) == sorted(ocols),
               hash_ok=digest(cols, rows) == digest(ocols, orows))
    if not res["cols_ok"]:
        res["cols"] = (cols, ocols)
    res["ok"] = res["cols_ok"] and res["hash_ok"] and len(rows) == len(orows)
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from linemill.plans.catalog import QUERIES
    from linemill.session import local_session
    names = argv[2:] or list(QUERIES)
    spark = local_session()
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:400]}
        bad += not r.get("ok", r.get("oracle", 0) is None)
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
