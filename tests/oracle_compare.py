"""Run registered queries in Spark and their DuckDB oracles; compare rows.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamfold.sources.tables import TABLES, table_path  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


def spark_rows(df) -> pd.DataFrame:
    return pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)


def compare(spark, name: str, sf_dir: str, queries: dict, sqls: dict, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries[name](spark, sf_dir)
    s = spark_rows(sdf)
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s), "spark_sec": round(t1 - t0, 2)}
    if name not in sqls:
        res["status"] = "no-oracle"
        return res
    d = con.execute(sqls[name]).df()
    res["oracle_rows"] = len(d)
    if sorted(s.columns) != sorted(d.columns):
        res["status"] = f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
        return res
    rs, rd = rows(s), rows(d)
    if rs == rd:
        res["status"] = "match"
    else:
        diff = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        res["status"] = f"values differ ({len(rs)} vs {len(rd)}): {diff}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from streamfold.session import build_session
    import __spark_entry__ as entry
    if os.environ.get("PLAIN_SESSION"):
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build_session(extra={"spark.sql.session.timeZone": os.environ.get("SF_TZ", "UTC")})
    q, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names or list(q):
        try:
            r = compare(spark, n, sf_dir, q, sqls, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"error: {type(e).__name__}: {str(e)[:400]}"}
        bad += r["status"] not in ("match", "no-oracle")
        print(r, flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
