"""Upsert of newly arrived month files, each file once.

The same result as the monthly backfill, driven by what has arrived in a
folder: the checkpoint remembers the files already taken, and because an
upsert can be repeated, a batch that is retried after a failure does no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from trip_marts.operators.upsert import upsert_table
from trip_marts.sources.files import as_batch


def ingest_arrivals(
    spark: SparkSession,
    folder: str,
    taxi_type: str,
    schema: StructType,
    table: str,
    checkpoint: str,
    files_per_batch: int = 1,
) -> StreamingQuery:
    """Start a query that takes all waiting files and then stops.

    One file per batch keeps months in order of arrival, so that a later file
    replaces the rows of an earlier one. ``checkpoint`` must be a folder every
    node can reach.
    """

    def upsert(rows: DataFrame, _batch_id: int) -> None:
        upsert_table(rows, table)

    arrivals = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .parquet(folder)
    )
    return (
        as_batch(arrivals, taxi_type)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
