"""Compares queries with their SQL on a data folder; prints a line each. Run: python tests/oracle.py [folder] [name...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, bool):
        return v
    if hasattr(v, "as_integer_ratio"):
        return round(float(v), 6) + 0.0
    return str(v)


def compare(spark, folder: str, name: str, query, sql: str) -> str:
    con = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        t = os.path.basename(p)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}'")
    df = query(spark, folder)
    cols = sorted(df.columns)
    a = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} against {sorted(names)}"
    at = [names.index(c) for c in cols]
    b = sorted((tuple(norm(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    if len(a) != len(b):
        only = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
        return f"{len(a)} rows against {len(b)}: {only}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ: {wrong[:3]}" if wrong else ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    args = sys.argv[1:] or ["/root/testdata/sf0.01"]
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sqls = e.oracle_sql()
    for name, query in e.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        began = time.time()
        try:
            said = compare(spark, args[0], name, query, sqls[name]) if name in sqls else f"no SQL; {query(spark, args[0]).count()} rows"
        except Exception as x:  # noqa: BLE001
            said = f"FAILED {type(x).__name__}: {str(x)[:600]}"
        print(f"{name}: {said or 'same'} ({time.time() - began:.1f} s)", flush=True)
