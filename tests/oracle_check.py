"""Run registered queries in Spark and their oracle SQL in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import pandas as pd
    if v is None or v is pd.NA or v is pd.NaT:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~",)
        if v == int(v) and abs(v) < 2 ** 53:
            return ("v", int(v))
        return ("f", round(v, 6))
    if hasattr(v, "item"):
        v = v.item()
        return _norm(v)
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    return ("v", v)


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x) and False) else x) for x in rec))
    return cols, sorted(out, key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def spark_types(sdf):
    return {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}


def duck_types(con, sql):
    rel = con.sql(sql)
    return {c: str(t) for c, t in zip(rel.columns, rel.types)}


def compare(spark, con, name: str, sf_dir: str):
    from __spark_entry__ import oracle_sql, queries
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return {"name": name, "ok": None, "rows": len(spdf), "spark_s": round(t1 - t0, 2)}
    dpdf = con.execute(sql).df()
    scols, srows = rows_of(spdf)
    dcols, drows = rows_of(dpdf)
    st, dt = spark_types(sdf), duck_types(con, sql)
    types_ok = st == dt
    ok = scols == dcols and srows == drows and types_ok
    res = {"name": name, "ok": ok, "rows": (len(srows), len(drows)), "spark_s": round(t1 - t0, 2)}
    if not types_ok:
        res["types"] = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    if not ok:
        res["cols"] = (scols, dcols)
        ds = [r for r in srows if r not in set(drows)][:3]
        dd = [r for r in drows if r not in set(srows)][:3]
        res["spark_only"] = ds
        res["duck_only"] = dd
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from quire.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    from __spark_entry__ import queries
    con = duck(sf_dir)
    bad = 0
    import faulthandler
    for n in names or list(queries()):
        # watchdog: print every thread's stack if one query stalls
        faulthandler.dump_traceback_later(300, exit=False)
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        faulthandler.cancel_dump_traceback_later()
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)


if __name__ == "__main__":
    main(sys.argv)
