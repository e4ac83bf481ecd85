"""Run registered queries against their SQL: python tests/check.py [dir] [names...]"""

import importlib
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def normal(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    if isinstance(value, float):
        return repr(value)
    return str(value)


def compare(spark, name, source, entry, db):
    started = time.time()
    df = entry.queries()[name](spark, source)
    ours = [tuple(r) for r in df.collect()]
    took = time.time() - started
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"{len(ours)} rows, no SQL", took
    theirs = db.sql(sql)
    names, types = theirs.columns, [str(t) for t in theirs.types]
    theirs = theirs.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}", took
    order_ours = [df.columns.index(c) for c in sorted(names)]
    order_theirs = [names.index(c) for c in sorted(names)]
    a = sorted(tuple(normal(r[i]) for i in order_ours) for r in ours)
    b = sorted(tuple(normal(r[i]) for i in order_theirs) for r in theirs)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        return f"{len(a)} / {len(b)} rows differ: {only_a} / {only_b}", took
    return f"ok {len(a)} rows {df.dtypes} {types}", took


def connect(source):
    db = duckdb.connect()
    for table in TABLES:
        db.sql(f"create view {table} as select * from '{source}/{table}.parquet'")
    return db


if __name__ == "__main__":
    source = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry = importlib.import_module("__spark_entry__")
    db = connect(source)
    for name in sys.argv[2:] or entry.queries():
        try:
            result, took = compare(spark, name, source, entry, db)
        except Exception as error:
            result, took = f"ERROR {type(error).__name__} {str(error)[:600]}", 0
        print(f"{name:24s} {took:6.2f}s {result}", flush=True)
