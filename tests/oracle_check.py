"""Compare each registered Spark query with its DuckDB oracle (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = sdf.collect()
    t1 = time.time()
    scols = sdf.columns
    res = {"key": key, "rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS spark={scols} duck={dcols}"
        return res
    order = sorted(range(len(scols)), key=lambda i: scols[i])
    dorder = [dcols.index(scols[i]) for i in order]
    a = sorted((tuple(_norm(r[i]) for i in order) for r in srows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in dorder) for r in drows), key=repr)
    if a == b:
        res["status"] = "OK"
    else:
        res["status"] = "VALUES"
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["only_spark"] = list(sa - sb)[:3]
        res["only_duck"] = list(sb - sa)[:3]
    stypes = dict(sdf.dtypes)
    res["types"] = {c: (stypes[c], str(t)) for c, t in zip(dcols, rel.types)}
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    import __spark_entry__ as E
    from harvest.session import get_spark
    extra = {"spark.sql.session.timeZone": os.environ["ORACLE_TZ"]} if os.environ.get("ORACLE_TZ") else None
    spark = get_spark("local[8]", shuffle_partitions=8, extra=extra)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        try:
            r = compare(spark, con, k, qs[k], sqls.get(k), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        ok = r["status"] in ("OK", "rows-only")
        bad += not ok
        types = r.pop("types", {})
        print(("  " if ok else "!!"), r, flush=True)
        if not ok and types:
            print("     types", types)
    print("FAILED", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
