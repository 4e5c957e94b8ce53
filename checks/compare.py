"""Run registered queries next to their SQL: `python -m checks.compare FOLDER [NAME ...]`."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "item"):
        value = value.item()
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, in an order of their own."""
    names = sorted(frame.columns)
    rows = [tuple(map(_plain, row)) for row in frame[names].itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def difference(spark_frame: DataFrame, sql: str, connection) -> str | None:
    """What differs, or None."""
    ours, theirs = spark_frame.toPandas(), connection.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"
    ours, theirs = rows_of(ours), rows_of(theirs)
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for left, right in zip(ours, theirs):
        if repr(left) != repr(right):
            return f"row {left!r} and {right!r}"
    return None


def main(folder: str, *names: str) -> int:
    from chatlake.session import build_session

    spark: SparkSession = build_session(
        master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = duck(folder), 0
    for name in names or QUERIES:
        start = time.perf_counter()
        try:
            found = difference(QUERIES[name](spark, folder), ORACLE[name], connection)
        except Exception as error:  # report and go on with the other queries
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failures += found is not None
        print(f"{name:32} {time.perf_counter() - start:6.2f}s  {found or 'equal'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(min(main(*sys.argv[1:]), 1))
