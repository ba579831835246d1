"""Compare registered queries with their SQL, as the driver does: python -m tests.oracle [names]."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def as_bag(columns, rows):
    """Rows as a bag, columns in the order of their names."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in rows)


def difference(df, connection, sql) -> str | None:
    """None when the DataFrame and the SQL agree, else what differs."""
    result = connection.execute(sql)
    wanted_columns, wanted = as_bag([d[0] for d in result.description], result.fetchall())
    columns, got = as_bag(df.columns, [tuple(row) for row in df.collect()])
    if columns != wanted_columns:
        return f"columns {columns} / {wanted_columns}"
    if got != wanted:
        extra, missing = list((got - wanted).items()), list((wanted - got).items())
        return f"{sum(got.values())} / {sum(wanted.values())} rows; {extra[:2]} / {missing[:2]}"
    return None


def main(names: list[str]) -> None:
    import os

    from pyspark.sql import SparkSession

    import __spark_entry__ as contract
    from marlstone.session import RECOMMENDED_CONF

    builder = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    for key, value in {**RECOMMENDED_CONF, "spark.ui.enabled": "false", "spark.driver.memory": "8g"}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    folder = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    connection = connect(folder)
    queries, sql = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                problem = difference(df, connection, sql[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
