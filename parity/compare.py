"""Run a query and its SQL side by side and compare columns, row count and values.

``python -m parity.compare [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from dataclasses import dataclass
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from parity.statements import STATEMENTS
from tillstone.registry import QUERIES
from tillstone.sources.retail_views import BASE_TABLES

DEFAULT_DIR = "/root/testdata/sf0.01"


@dataclass
class Comparison:
    name: str
    rows: int
    seconds: float
    problem: str | None


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"create view {table} as select * from '{Path(sf_dir) / table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, Decimal):
        return f"{value.normalize():f}"
    if isinstance(value, float):
        return f"{Decimal(repr(value)).normalize():f}"
    return value if value is None else str(value)


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def _kind(type_name: str) -> str:
    kinds = {
        "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
    }
    name = str(type_name)
    return kinds.get(name, name.lower())


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> Comparison:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    ours = df.collect()
    seconds = time.time() - start
    cursor = connection.execute(STATEMENTS[name])
    expected_types = {d[0]: _kind(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    problem = None
    our_types = dict(df.dtypes)
    if set(our_types) != set(expected_types):
        problem = f"columns {sorted(our_types)} against {sorted(expected_types)}"
    else:
        types = {c: (our_types[c], expected_types[c]) for c in our_types if our_types[c] != expected_types[c]}
        left, right = _bag(df.columns, ours), _bag(list(expected_types), theirs)
        if left != right:
            extra, missing = left - right, right - left
            problem = (
                f"{len(ours)} rows against {len(theirs)}; {sum(extra.values())} only in ours, e.g. "
                f"{list(extra)[:2]}; {sum(missing.values())} only in theirs, e.g. {list(missing)[:2]}"
            )
        elif types:
            problem = f"types {types}"
    return Comparison(name, len(ours), seconds, problem)


def main(arguments: list[str]) -> int:
    from tillstone.session import build_session

    sf_dir = arguments[0] if arguments else DEFAULT_DIR
    names = arguments[1:] or list(QUERIES)
    spark = build_session(
        "parity", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names:
        try:
            result = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            result = Comparison(name, 0, 0.0, f"{type(error).__name__}: {str(error)[:600]}")
        failures += result.problem is not None
        print(f"{result.name:32s} {result.rows:8d} {result.seconds:6.2f}s {result.problem or 'ok'}", flush=True)
    print(f"{len(names) - failures} of {len(names)} equal")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
