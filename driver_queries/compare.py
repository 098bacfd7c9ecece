"""Row-by-row comparison of a query with its SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from driver_queries.oracle import ORACLE
from driver_queries.queries import QUERIES

# Result types that both engines must share, by the oracle's names.
SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


def connect_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(
    spark: SparkSession, oracle: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> str | None:
    """What differs in schema or rows, None if nothing does."""
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    described = oracle.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    if sorted(expected_types) != columns:
        return f"columns {columns} != {sorted(expected_types)}"
    types = {f.name: SPARK_TYPES.get(f.dataType.simpleString()) for f in result.schema.fields}
    if types != expected_types:
        wrong = {c: (types[c], expected_types[c]) for c in columns if types[c] != expected_types[c]}
        return f"types {wrong}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(oracle.execute(f"SELECT {quoted} FROM ({ORACLE[name]})").fetchall())
    actual = Counter(map(tuple, result.select(*columns).collect()))
    if actual != expected:
        only_spark = list((actual - expected).items())[:2]
        only_oracle = list((expected - actual).items())[:2]
        sizes = f"{sum(actual.values())} and {sum(expected.values())} rows"
        return f"{sizes}; only here {only_spark}; only there {only_oracle}"
    return None
