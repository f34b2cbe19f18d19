"""Run registered queries beside their SQL and compare: columns, types, rows, values.

    python -m checks.compare [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from skylog.session import build_session, drop_scratch

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB type to the Spark type that holds the same values.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sorted(rows, order):
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None when both agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    ours = df.collect()
    if name not in ORACLES:
        return None
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    types = [TYPES.get(str(d[1]), str(d[1])) for d in result.description]
    theirs = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    declared = dict(df.dtypes)
    mistyped = {c: (declared[c], t) for c, t in zip(columns, types) if declared[c] != t}
    if mistyped:
        return f"types {mistyped}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    names = sorted(columns)
    a = _sorted(ours, [df.columns.index(c) for c in names])
    b = _sorted(theirs, [columns.index(c) for c in names])
    different = [(x, y) for x, y in zip(a, b) if x != y]
    if different:
        return f"{len(different)} rows differ, first {different[0]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, connection, name, args.sf)
        except Exception as error:  # the report goes on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        drop_scratch(spark)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} of {len(args.names or QUERIES)} differ; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
