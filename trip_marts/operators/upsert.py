"""Keyed upsert: delete the rows whose key is in the batch, add the batch."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_marts.schemas import PICKUP_MONTH, ROW_KEY
from trip_marts.sources.tables import (
    add_missing_columns,
    align_to,
    create_like,
    partition_columns,
    replace_partitions,
    table_exists,
    widen_types,
)


def batch_keys(batch: DataFrame, keys: Sequence[str], month: str) -> DataFrame:
    """Each key of the batch once.

    Grouping by the month too does not change the result, as the month follows
    from the key. It makes the later join shuffle the reduced keys again, and
    only a join of two freshly shuffled sides can be split at run time when
    one key holds many of the table's rows.
    """
    return batch.select(*keys, month).distinct().select(*keys)


def matched_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], month: str = PICKUP_MONTH
) -> DataFrame:
    """Rows of the table that the batch replaces."""
    return target.join(batch_keys(batch, keys, month), list(keys), "left_semi")


def unmatched_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], month: str = PICKUP_MONTH
) -> DataFrame:
    """Rows of the table that the batch leaves alone."""
    return target.join(batch_keys(batch, keys, month), list(keys), "left_anti")


def upsert_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = (ROW_KEY,),
    month: str = PICKUP_MONTH,
) -> DataFrame:
    """The table after the upsert. Equal keys inside the batch all stay."""
    kept = unmatched_rows(target, batch, keys, month)
    return kept.unionByName(batch, allowMissingColumns=True)


def upsert_table(
    batch: DataFrame,
    table: str,
    keys: Sequence[str] = (ROW_KEY,),
    month: str = PICKUP_MONTH,
    partition_by: Sequence[str] | None = None,
) -> None:
    """Upsert a batch into a table partitioned by pickup month.

    The pickup time is part of the key, so a row to replace is always in the
    batch's own partitions: only those are read and rewritten. The table is
    created on first use and widened by columns it does not have yet.
    """
    spark = batch.sparkSession
    if not table_exists(spark, table):
        create_like(batch, table, partition_by or (month,))
    widen_types(batch, table)
    add_missing_columns(batch, table)
    target = spark.table(table)
    batch = align_to(batch, target)
    affected = target.where(same_partitions(batch, partition_columns(spark, table)))
    replace_partitions(upsert_rows(affected, batch, keys, month), table)


def same_partitions(batch: DataFrame, columns: Sequence[str]) -> Column:
    """Filter to the partitions a batch has rows in, null being one of them.

    The values are months and services, a short list however large the batch;
    as literals they prune directories before anything is read.
    """
    found = F.lit(False)
    for values in batch.select(*columns).distinct().collect():
        same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, values, strict=True)]
        found = found | reduce(and_, same)
    return found
