"""Run queries next to their oracle SQL and report differences: ``python tests/compare.py SF [names…]``."""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", "/tmp/cellspark-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def rows_of(frame_rows, cols, order):
    at = [cols.index(c) for c in order]
    return sorted(((tuple(normal(r[i]) for i in at)) for r in frame_rows), key=repr)


def oracle_rows(sql: str, sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    return cur.fetchall(), [d[0] for d in cur.description]


def compare(spark, name: str, sf_dir: str, queries: dict | None = None, sqls: dict | None = None):
    """(equal, message) for one query, a registered one by default."""
    import __spark_entry__ as entry

    start = time.time()
    df = (queries or entry.queries())[name](spark, sf_dir)
    got = df.collect()
    spent = time.time() - start
    sql = (sqls or entry.oracle_sql()).get(name)
    if sql is None:
        return True, f"{len(got)} rows, no oracle, {spent:.1f}s"
    start = time.time()
    want, want_cols = oracle_rows(sql, sf_dir)
    duck = time.time() - start
    if sorted(df.columns) != sorted(want_cols):
        return False, f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    order = sorted(df.columns)
    a, b = rows_of(got, df.columns, order), rows_of(want, want_cols, order)
    if a == b:
        return True, f"{len(a)} rows, {spent:.1f}s (oracle {duck:.1f}s)"
    only_a, only_b = [x for x in a if x not in set(b)], [x for x in b if x not in set(a)]
    lines = [f"{len(a)} != {len(b)} rows; {len(only_a)} only here, {len(only_b)} only there", str(order)]
    lines += ["  spark  " + repr(x) for x in only_a[:3]] + ["  oracle " + repr(x) for x in only_b[:3]]
    return False, "\n".join(lines)


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf = f"/root/testdata/sf{sys.argv[1]}"
    spark = session()
    for q in sys.argv[2:] or entry.queries():
        try:
            ok, message = compare(spark, q, sf)
        except Exception as e:  # report and go on to the next query
            ok, message = False, f"{type(e).__name__}: {str(e)[:1500]}"
        print("ok  " if ok else "FAIL", q, message, flush=True)
