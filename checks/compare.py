"""Run registered queries next to their SQL and compare names, row counts and values.

    python -m checks.compare [folder] [name prefix ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexispark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value + 0.0:.9g}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


def difference(spark, connection, query, sql, folder) -> str | None:
    """None if equal, otherwise what differs."""
    df = query(spark, folder)
    spark_columns, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if spark_rows else "no rows"
    result = connection.execute(sql)
    sql_columns, sql_rows = rows_of([d[0] for d in result.description], result.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} != {sql_columns}"
    if not spark_rows:
        return "no rows"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    for mine, theirs in zip(spark_rows, sql_rows):
        if mine != theirs:
            return f"first difference {str(mine)[:300]} != {str(theirs)[:300]}"
    return None


def main() -> int:
    from checks.catalog import ORACLES, QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark, connection, failed = session(), database(folder), 0
    for name, query in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            problem = difference(spark, connection, query, ORACLES.get(name), folder)
        except Exception as error:  # a report over all queries, so one failure must not end it
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        kind = "sql " if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
