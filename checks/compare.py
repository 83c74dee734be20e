"""Run registered queries beside their SQL and compare all values.

    python -m checks.compare SF_DIR [QUERY ...]
"""
from __future__ import annotations

import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.registry import QUERIES
from gridlore.sources import written_tables


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; None if nothing does."""
    result = QUERIES[name](spark, sf_dir)
    found = rows_of(result.columns, (tuple(row) for row in result.collect()))
    cursor = con.execute(ORACLE[name])
    columns = [column[0] for column in cursor.description]
    wanted = rows_of(columns, cursor.fetchall())
    if sorted(columns) != sorted(result.columns):
        return f"columns {result.columns} and {columns}"
    kinds = {name: KINDS[kind] for name, kind in result.dtypes}
    wanted_kinds = {column[0]: str(column[1]) for column in cursor.description}
    if kinds != wanted_kinds:
        return f"types {kinds} and {wanted_kinds}"
    if found != wanted:
        return (
            f"{found.total()} and {wanted.total()} rows; "
            f"only here {list((found - wanted).items())[:3]}, "
            f"only in SQL {list((wanted - found).items())[:3]}"
        )
    return None


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="compare-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        start = time.time()
        with written_tables(spark):
            problem = difference(spark, con, sf_dir, name)
        failed += problem is not None
        print(f"{name:32} {time.time() - start:6.2f}s  {problem or 'equal'}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
