"""Keyed upsert into a table stored in buckets of the row key.

The stored rows already lie where a join on the key needs them, so an upsert shuffles the
batch only: neither the anti join nor the rewrite of the changed months moves a stored
row to another task. A bucket is picked by the key and a part number that follows
from the row's other columns, so that rows which share one key are spread over
``parts`` buckets; a key of the batch is looked up in each of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_marts.operators.upsert import batch_keys, same_partitions
from trip_marts.schemas import PICKUP_MONTH, ROW_KEY
from trip_marts.sources.tables import (
    add_missing_columns,
    align_to,
    bucket_spec,
    dynamic_overwrite,
    partition_columns,
    table_exists,
    widen_types,
)

KEY_PART = "key_part"
# Property of the table that says how many parts it was created with.
KEY_PARTS = "key_parts"


@dataclass(frozen=True)
class Buckets:
    """How a table is stored; the number is that of tasks that read or rewrite a month's rows."""

    number: int = 64
    parts: int = 4
    keys: tuple[str, ...] = (ROW_KEY,)
    month: str = PICKUP_MONTH

    @property
    def columns(self) -> list[str]:
        return [*self.keys, KEY_PART]


def key_part(columns: Sequence[str], layout: Buckets) -> Column:
    """Part number of a row, from all of its columns but the key."""
    rest = [F.col(f"`{c}`").cast("string") for c in columns if c not in (*layout.columns, layout.month)]
    return F.pmod(F.xxhash64(*rest), F.lit(layout.parts)).cast("int")


def create_bucketed(batch: DataFrame, table: str, layout: Buckets) -> None:
    """An empty table with the columns of ``batch``, in buckets sorted by key."""
    empty = batch.withColumn(KEY_PART, F.lit(0)).limit(0)
    (
        empty.write.format("parquet")
        .partitionBy(layout.month)
        .bucketBy(layout.number, *layout.columns)
        .sortBy(*layout.keys)
        .mode("ignore")
        .saveAsTable(table)
    )
    batch.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{KEY_PARTS}' = '{layout.parts}')")


def stored_layout(spark: SparkSession, table: str, layout: Buckets) -> Buckets:
    """The layout with the numbers that the table was created with."""
    parts = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == KEY_PARTS).first()
    return replace(layout, number=bucket_spec(spark, table)[0], parts=int(parts["value"]))


def unmatched_stored(stored: DataFrame, batch: DataFrame, layout: Buckets) -> DataFrame:
    """Stored rows whose key is not in the batch; the stored side is not shuffled.

    Every key of the batch comes once for each part.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(layout.parts - 1)))
    keys = batch_keys(batch, layout.keys, layout.month).withColumn(KEY_PART, parts)
    keys = keys.repartition(layout.number, *layout.columns)
    return stored.join(keys.hint("merge"), layout.columns, "left_anti")


def writers(spark: SparkSession, layout: Buckets) -> int:
    """Tasks that write the batch: a multiple of the buckets, at least the shuffle's partitions.

    A row's task is its hash modulo this number, so every task holds rows of one bucket
    only and a large batch is spread over many tasks, each bucket getting several files.
    """
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return layout.number * max(1, -(-shuffled // layout.number))


def upsert_bucketed(batch: DataFrame, table: str, layout: Buckets = Buckets()) -> None:
    """Upsert a batch, reading and rewriting only the months it has rows in.

    The table is created on first use. A table that exists keeps its own numbers of
    buckets and parts. Wider types and new columns are taken over as in ``upsert_table``.
    """
    spark = batch.sparkSession
    batch = batch.drop(KEY_PART)
    if not table_exists(spark, table):
        create_bucketed(batch, table, layout)
    layout = stored_layout(spark, table, layout)
    batch = batch.withColumn(KEY_PART, key_part(sorted(batch.columns), layout))
    widen_types(batch, table)
    add_missing_columns(batch, table)
    target = spark.table(table)
    batch = align_to(batch, target)
    affected = target.where(same_partitions(batch, partition_columns(spark, table)))
    kept = unmatched_stored(affected, batch, layout)
    rows = align_to(kept.unionByName(batch.repartition(writers(spark, layout), *layout.columns)), target)
    # no rebalance here: every task holds rows of one bucket only and writes one file of it a month
    with dynamic_overwrite(spark):
        rows.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
