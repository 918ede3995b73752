"""Compare registered queries with their SQL in DuckDB. Also runnable: ``python tests/compare.py <folder> [name...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*[f"`{name}`" for name in names]).collect())


def duck_rows(connection, sql):
    relation = connection.execute(sql)
    columns = [item[0] for item in relation.description]
    order = sorted(range(len(columns)), key=lambda position: columns[position])
    return [columns[i] for i in order], Counter(tuple(row[i] for i in order) for row in relation.fetchall())


def differences(spark, connection, folder, query, sql):
    """Empty string when both give the same rows and columns."""
    names, ours = spark_rows(query(spark, folder))
    expected_names, expected = duck_rows(connection, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if ours != expected:
        extra, missing = ours - expected, expected - ours
        return (
            f"{sum(ours.values())} rows, expected {sum(expected.values())}; extra {list(extra)[:3]}; "
            f"missing {list(missing)[:3]}"
        )
    return ""


if __name__ == "__main__":
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    target, wanted = sys.argv[1], sys.argv[2:]
    database = duck(target)
    statements = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            if name in statements:
                problem = differences(session, database, target, query, statements[name])
            else:
                problem = "" if query(session, target).count() >= 0 else "?"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        rows = "" if problem else "ok"
        print(f"{name:32s} {time.time() - started:6.2f}s {rows} {problem}", flush=True)
