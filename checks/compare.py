"""Run every query next to its SQL and compare rows, as a multiset, column by column.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.expected import EXPECTED
from checks.queries import QUERIES
from sluice.session import build_session


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(df: pd.DataFrame) -> list[tuple]:
    def plain(value: object) -> object:
        if value is None or value is pd.NaT or (isinstance(value, float) and pd.isna(value)):
            return None
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        return value.item() if hasattr(value, "item") else value

    ordered = df[sorted(df.columns)].astype(object)
    return sorted((tuple(map(plain, row)) for row in ordered.itertuples(index=False)), key=repr)


def compare(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """'' when equal, otherwise what differs."""
    actual = QUERIES[name](spark, sf_dir)
    fetched = [row.asDict() for row in actual.collect()]
    got = pd.DataFrame(fetched, columns=actual.columns, dtype=object)
    if name not in EXPECTED:
        return "" if len(got) else "no rows"
    relation = connection.sql(EXPECTED[name])
    want = pd.DataFrame(relation.fetchall(), columns=relation.columns, dtype=object)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    left, right = _rows(got), _rows(want)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # keep going, report all
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        checked = "sql" if name in EXPECTED else "rows only"
        print(f"{name:32} {time.time() - start:6.2f}s {checked:9} {problem or 'ok'}", flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(main())
