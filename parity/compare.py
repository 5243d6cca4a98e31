"""Compare registered queries with their SQL: ``python -m parity.compare DIR [names]``.

A check for developers and tests; it brings both results to the driver, which the
library itself never does.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from parity.oracle import oracle_queries
from parity.spark_queries import QUERIES


def duckdb_on(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(
            f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')"
        )
    return connection


def _canonical(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(
    spark: SparkSession, duck: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> str | None:
    """What differs between both results, or None."""
    frame = QUERIES[name](spark, sf_dir)
    ours = _canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = duck.execute(oracle_queries()[name])
    theirs = _canonical([c[0] for c in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} against {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows against {len(theirs[1])}"
    for mine, other in zip(ours[1], theirs[1], strict=True):
        if mine != other:
            return f"{mine} against {other}"
    return None


def main(sf_dir: str, *names: str) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    duck = duckdb_on(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        found = difference(spark, duck, sf_dir, name)
        failed += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {found or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
