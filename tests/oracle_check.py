"""Run registered queries next to their SQL and compare whole results.

    python tests/oracle_check.py [folder] [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


ROWS = [0]


def open_tables(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else repr(value + 0.0))
    return (3, f"{type(value).__name__}:{value}")


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, statement: str) -> str:
    """Empty when equal (the row count goes to ROWS), else what differs."""
    spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    ROWS[0] = len(spark_rows)
    found = con.execute(statement)
    names = [d[0] for d in found.description]
    sql_rows = _rows(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(spark_rows) != len(sql_rows):
        return f"{len(spark_rows)} rows != {len(sql_rows)}"
    off = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    if off:
        a, b = off[0]
        cells = [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
        return f"{len(off)} of {len(sql_rows)} rows differ, first: {cells} in {a}"
    return ""


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("feedloom-check")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(folder: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry

    spark, con = session(), open_tables(folder)
    queries, statements = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        start = time.time()
        print(f"{name} ...", end="\r", flush=True)
        try:
            df = queries[name](spark, folder)
            if name in statements:
                result = differences(df, con, statements[name]) or f"equal ({ROWS[0]} rows)"
            else:
                result = f"no SQL ({df.count()} rows)"
        except Exception as e:  # report and go on
            result = f"FAILED {type(e).__name__}: {str(e)[:300]}"
        bad += not result.startswith(("equal", "no SQL"))
        print(f"{name:28s} {time.time() - start:6.1f}s  {result}", flush=True)
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(where, sys.argv[2:]) else 0)
