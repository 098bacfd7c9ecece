"""Compare every query with its SQL on one data folder.

Usage: python tools/compare.py [data folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from driver_queries.compare import connect_oracle, difference  # noqa: E402
from driver_queries.oracle import ORACLE  # noqa: E402
from driver_queries.queries import QUERIES  # noqa: E402
from trip_marts.session import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("compare", "local[8]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    oracle: duckdb.DuckDBPyConnection = connect_oracle(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        problem = difference(spark, oracle, sf_dir, name) if name in ORACLE else "no SQL"
        failed += problem is not None
        print(f"{name:36s} {time.time() - start:6.2f}s  {problem or 'equal'}", flush=True)
    return failed


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(folder, sys.argv[2:]))
