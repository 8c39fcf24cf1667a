"""Run registered queries and their SQL side by side and report differences.

    python -m cadastra.checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from cadastra.checks.oracles import ORACLES
from cadastra.checks.queries import QUERIES
from cadastra.shared import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _canonical(table: pa.Table) -> list[tuple[str, ...]]:
    columns = [
        [repr(v) if isinstance(v, float) else str(v) for v in table.column(c).to_pylist()]
        for c in sorted(table.column_names)
    ]
    return sorted(zip(*columns))


def difference(got: pa.Table, expected: pa.Table) -> str | None:
    """None when both hold the same columns, types and rows, else what differs."""
    if sorted(got.column_names) != sorted(expected.column_names):
        return f"columns {sorted(got.column_names)} and {sorted(expected.column_names)}"
    kinds = [
        f"{c}: {got.schema.field(c).type} and {expected.schema.field(c).type}"
        for c in got.column_names
        if got.schema.field(c).type != expected.schema.field(c).type
    ]
    left, right = _canonical(got), _canonical(expected)
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    pairs = [(a, b) for a, b in zip(left, right) if a != b]
    if pairs:
        return f"{len(pairs)} rows differ, first {pairs[0]} {kinds}"
    return f"types differ: {kinds}" if kinds else None


def check(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    result = QUERIES[name](spark, sf_dir)
    if name not in ORACLES:
        return None if result.count() > 0 else "no rows"
    got, expected = result.toArrow(), connection.execute(ORACLES[name]).to_arrow_table()
    if not got.num_rows and not expected.num_rows:
        return "no rows on either side"
    return difference(got, expected)


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    for name in names or QUERIES:
        started = time.monotonic()
        try:
            found = check(spark, connection, sf_dir, name)
        except Exception as error:  # report every query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failures += found is not None
        print(f"{name:28} {time.monotonic() - started:6.2f}s {found or 'ok'}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main())
