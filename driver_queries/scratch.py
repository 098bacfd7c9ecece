"""Shared folder and database for queries that write before they read."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import SparkSession

from trip_marts.plans.pipeline import Lake

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's checkpoint folder.

    Only a local session without that setting gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder all nodes share")
        root = _local_root()
    return f"{root}/{uuid4().hex}"


def scratch_lake(spark: SparkSession) -> Lake:
    """A new database whose tables are stored in a scratch folder."""
    name = f"scratch_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_folder(spark)}'")
    return Lake(name)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="trip-marts-")
