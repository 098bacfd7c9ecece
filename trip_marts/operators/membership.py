"""Upsert that appends where nothing stored can match.

A Bloom filter of the stored keys is kept for every month, as a table of the filter's
non-zero words. Months in which no key of a batch is possibly stored get the batch
appended; only the others are read and rewritten. A false positive costs a rewrite
that changes nothing, never a wrong row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_marts.operators.upsert import same_partitions, upsert_table
from trip_marts.schemas import PICKUP_MONTH, ROW_KEY
from trip_marts.sources.tables import (
    add_missing_columns,
    append_rows,
    refresh_table,
    replace_partitions,
    table_exists,
    widen_types,
)

WORD, BITS = "word", "bits"


@dataclass(frozen=True)
class KeyFilter:
    """Size of a month's filter: ``bits`` is a power of two, some 16 times a month's keys."""

    bits: int = 1 << 27
    hashes: int = 3
    keys: tuple[str, ...] = (ROW_KEY,)
    month: str = PICKUP_MONTH


def filter_table(table: str) -> str:
    """The table beside ``table`` that holds its filters."""
    return f"{table}__keys"


def key_words(rows: DataFrame, how: KeyFilter) -> DataFrame:
    """``(month, key_hash, word, bits)``: the bits of every key, one row for each hash function."""
    hashes = [F.pmod(F.xxhash64(*how.keys, F.lit(k)), F.lit(how.bits)) for k in range(how.hashes)]
    at = rows.select(
        how.month, F.xxhash64(*how.keys, F.lit(-1)).alias("key_hash"), F.explode(F.array(*hashes)).alias("at")
    )
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    return at.select(how.month, "key_hash", F.shiftright("at", 6).alias(WORD), bit.alias(BITS))


def merged(words: DataFrame, how: KeyFilter) -> DataFrame:
    """One row for each month and word; filters of several sets of rows add up by or."""
    return words.groupBy(WORD, how.month).agg(F.bit_or(BITS).alias(BITS)).select(WORD, BITS, how.month)


def months_to_rewrite(batch: DataFrame, filters: DataFrame, how: KeyFilter) -> DataFrame:
    """Months of the batch in which at least one of its keys is possibly stored.

    Both sides of the join are slim: words of the batch's keys, and the filters' words.
    """
    stored = filters.select(F.col(how.month).alias("_month"), F.col(WORD).alias("_word"), F.col(BITS).alias("_bits"))
    words = key_words(batch, how).distinct()
    met = F.col(how.month).eqNullSafe(F.col("_month")) & (F.col(WORD) == F.col("_word"))
    found = words.join(stored, met).where(F.col("_bits").bitwiseAND(F.col(BITS)) != 0)
    sought = words.groupBy(how.month, "key_hash").agg(F.count(F.lit(1)).alias("sought"))
    hits = found.groupBy(how.month, "key_hash").agg(F.count(F.lit(1)).alias("hits"))
    hits = hits.select(F.col(how.month).alias("_month"), F.col("key_hash").alias("_hash"), "hits")
    same = F.col(how.month).eqNullSafe(F.col("_month")) & (F.col("key_hash") == F.col("_hash"))
    return sought.join(hits, same).where("hits = sought").select(how.month).distinct()


def ensure_filter(spark: SparkSession, table: str, how: KeyFilter) -> str:
    """The filters of a table, built from its keys if there are none yet."""
    name = filter_table(table)
    if not table_exists(spark, name):
        refresh_table(merged(key_words(spark.table(table), how), how), name, (how.month,))
    return name


def upsert_filtered(
    batch: DataFrame, table: str, how: KeyFilter = KeyFilter(), partition_by: Sequence[str] | None = None
) -> list[str | None]:
    """Upsert a batch; returns the months that had to be rewritten.

    The batch's keys enter the filters before its rows enter the table, so that a
    run that stops in between leaves filters that know too much, which does no harm:
    run again, it rewrites months that it could have appended to.

    Every step below reads the batch; it is computed once, joins and all, and
    checkpointed to the folder that all executors share, so the loss of one
    does not lose it.
    """
    return _upsert_filtered(batch.checkpoint(eager=True), table, how, partition_by)


def _upsert_filtered(
    batch: DataFrame, table: str, how: KeyFilter, partition_by: Sequence[str] | None
) -> list[str | None]:
    spark = batch.sparkSession
    if not table_exists(spark, table):
        upsert_table(batch.limit(0), table, how.keys, how.month, partition_by)
    name = ensure_filter(spark, table, how)
    filters = spark.table(name)
    touched = same_partitions(batch, [how.month])
    months = sorted((r[0] for r in months_to_rewrite(batch, filters.where(touched), how).collect()), key=str)
    words = key_words(batch, how).select(WORD, BITS, how.month)
    replace_partitions(merged(filters.where(touched).unionByName(words), how), name)
    rewrite = F.lit(False)
    for month in months:
        rewrite = rewrite | F.col(how.month).eqNullSafe(F.lit(month))
    if months:
        upsert_table(batch.where(rewrite), table, how.keys, how.month, partition_by)
    widen_types(batch, table)
    add_missing_columns(batch, table)
    append_rows(batch.where(~rewrite), table)
    spark.catalog.refreshTable(table)
    return months
