from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trip_marts.plans.pipeline import Lake  # noqa: E402
from trip_marts.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    folder = tmp_path_factory.mktemp("spark")
    settings = {
        "spark.sql.shuffle.partitions": "2",
        "spark.default.parallelism": "2",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.checkpoint.dir": str(folder / "checkpoint"),
    }
    session = build_session("tests", "local[4]", settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path) -> Lake:
    name = "lake_" + "".join(c for c in tmp_path.name if c.isalnum()).lower()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield Lake(name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)
