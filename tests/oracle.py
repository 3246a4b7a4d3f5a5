"""Runs queries on Spark and their SQL on DuckDB, and compares names, types and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()

TYPE_NAMES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(sf_dir, f"{name}.parquet").exists():
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def normal(rows) -> list[tuple]:
    clean = [tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    return sorted(clean, key=lambda row: tuple((v is None, str(v)) for v in row))


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and its SQL, or None."""
    columns = sorted(result.columns)
    expected = connection.sql(f"SELECT * FROM ({sql})")
    types = dict(zip(expected.columns, map(str, expected.types)))
    if sorted(types) != columns:
        return f"columns {columns} != {sorted(types)}"
    found_types = {name: TYPE_NAMES.get(kind, kind) for name, kind in result.dtypes}
    if found_types != types:
        return f"types {[(n, found_types[n], types[n]) for n in columns if found_types[n] != types[n]]}"
    ours = normal(result.select(*[f"`{c}`" for c in columns]).collect())
    theirs = normal(expected.select(", ".join(f'"{c}"' for c in columns)).fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries

    from surveylake.session import build_session

    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql, failed = connect(sf_dir), oracle_sql(), 0
    for name, build in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = difference(build(spark, sf_dir), connection, sql[name])
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parent.parent))
    sys.exit(bool(main(*sys.argv[1:])))
