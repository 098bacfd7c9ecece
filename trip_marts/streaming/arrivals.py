"""Upsert of newly arrived month files with a ledger, whatever columns they bring.

The stream carries the names of arrived files, not their rows, so a file may have other
columns or wider types than those before it: each batch reads its files with their own schema and the
table grows to hold them. A ledger records every file that has been upserted, with its size
and time. A batch that is delivered again, after a failure or with a new checkpoint, finds
its files there and does nothing; a file that was replaced under its old name is new.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trip_marts.operators.upsert import upsert_table
from trip_marts.sources.files import as_batch, scan_parquet
from trip_marts.sources.tables import append_rows, create_like, table_exists

LISTING_SCHEMA = "path string, modificationTime timestamp_ltz, length bigint, content binary"
LEDGER_SCHEMA = "path string, length bigint, modified timestamp_ltz, batch_id bigint, rows bigint"
FILE_KEY = ["path", "length", "modified"]

Upsert = Callable[[DataFrame, str], object]


def ledger_table(table: str) -> str:
    """The table beside ``table`` that records its files."""
    return f"{table}__arrivals"


def new_files(spark: SparkSession, files: list[Row], table: str) -> list[Row]:
    """Those of a batch's files that are not in the table's ledger yet, oldest first."""
    ledger, seen = ledger_table(table), set()
    if table_exists(spark, ledger):
        rows = spark.table(ledger).where(F.col("path").isin([f.path for f in files]))
        seen = {tuple(row) for row in rows.select(*FILE_KEY).collect()}
    return sorted((f for f in files if tuple(f) not in seen), key=lambda f: (f.modified, f.path))


def take_files(spark: SparkSession, found: list[Row], batch_id: int, taxi_type: str, table: str, upsert: Upsert) -> None:
    """Upsert files one after another, each recorded when it is in the table.

    In order of arrival a later file replaces the rows of an earlier one. If the run
    ends between the upsert and its record, the file is upserted again, which changes
    nothing.
    """
    ledger = ledger_table(table)
    for file in found:
        rows = as_batch(scan_parquet(spark, file.path), taxi_type, source_file=file.path)
        upsert(rows, table)
        entry = (file.path, file.length, file.modified, batch_id, rows.count())
        record = spark.createDataFrame([entry], LEDGER_SCHEMA).coalesce(1)
        create_like(record, ledger)
        append_rows(record, ledger)


def follow_arrivals(
    spark: SparkSession,
    folder: str,
    taxi_type: str,
    table: str,
    checkpoint: str,
    files_per_batch: int = 1,
    upsert: Upsert = upsert_table,
) -> StreamingQuery:
    """Start a query that takes all waiting files and then stops.

    ``upsert`` brings one file's rows into the table; any of the library's upserts
    fits. ``checkpoint`` must be a folder that every node can reach.
    """

    def take(files: DataFrame, batch_id: int) -> None:
        # names of a bounded number of files; the caller's session sees the table change
        found = new_files(spark, files.select(*FILE_KEY).collect(), table)
        take_files(spark, found, batch_id, taxi_type, table, upsert)

    names = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        # the content is pruned away: only the listing is read here
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )
    return (
        names.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
