"""Run every named query against its DuckDB oracle: python tests/check_oracles.py [sf_dir] [name ...]"""

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from cohortflow.session import build_session


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return repr(float(value))
    return str(value)


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in records)


def compare(spark, con, sf_dir, name, query, sql):
    start = time.time()
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    spent = time.time() - start
    if sql is None:
        return f"{name}: rows only {len(got)} ({spent:.1f}s)", len(got) > 0
    start = time.time()
    rel = con.sql(sql)
    names, want = rel.columns, rel.fetchall()
    want = rows(names, want)
    duck = time.time() - start
    if sorted(names) != sorted(df.columns):
        return f"{name}: COLUMNS {sorted(df.columns)} vs {sorted(names)}", False
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        lacking = [r for r in want if r not in set(got)][:2]
        return f"{name}: DIFFERS {len(got)} vs {len(want)} rows\n  spark {extra}\n  duck  {lacking}", False
    return f"{name}: ok {len(got)} rows (spark {spent:.1f}s, duckdb {duck:.1f}s)", True


def main(sf_dir="/root/testdata/sf0.01", *only):
    import __spark_entry__ as entry

    spark = build_session("check", os.environ.get("TEST_MASTER", "local[8]"), **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    oracles, failed = entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        try:
            message, fine = compare(spark, con, sf_dir, name, query, oracles.get(name))
        except Exception as e:
            message, fine = f"{name}: ERROR {str(e)[:1200]}", False
        print(message, flush=True)
        if not fine:
            failed.append(name)
    print("failed:", failed)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
