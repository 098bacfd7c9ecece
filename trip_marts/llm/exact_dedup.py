"""Exact duplicates by two passes over a Bloom filter.

The first pass hashes every text and counts, for each bit of the filter, how many
hashes fell on it; a bit is set where two or more did. The second pass looks every hash up:
a text whose bits are not all set has no equal and passes straight through. Only the
other rows are shuffled, and equal texts among them are told apart by their SHA-256.
A false positive of the filter costs a row's shuffle, never a wrong result.

The filter has 16 bits for each row, up to `MAX_BITS`; beyond that ever more rows are
shuffled, all of them at worst. Its bits are counted by Spark with a map-side combine, so
a text that makes up a third of the rows reaches each bit as one row for each task.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trip_marts.llm.groups import with_groups
from trip_marts.llm.shared import saved

#: Bits of the filter for each row, and the most it has: 128 MB on the driver and each executor.
BITS_A_ROW = 16
MAX_BITS = 1 << 30
LEAST_BITS = 1 << 16
HASHES = 2


def normalised(text: Column) -> Column:
    """The text without space and 0x09-0x0D; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def text_sha256(text: Column) -> Column:
    """What equal texts share."""
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def code_points(text: Column) -> Column:
    return F.char_length(F.coalesce(text, F.lit(""))).cast("long")


def filter_bits(rows: int) -> int:
    """Size of the filter: a power of two of at least `BITS_A_ROW` bits a row, bounded."""
    return min(MAX_BITS, max(LEAST_BITS, 1 << (BITS_A_ROW * max(rows, 1) - 1).bit_length()))


def _places(sha: Column, bits: int) -> list[Column]:
    """Bits of the filter that a hash falls on."""
    return [F.pmod(F.xxhash64(sha, F.lit(k)), F.lit(bits)) for k in range(HASHES)]


def repeated_bits(rows: DataFrame, bits: int) -> np.ndarray:
    """First pass: the filter, with a bit set where at least two of the `sha` fell.

    What comes to the driver is the filter in words of 64 bits, `bits` / 64 at most.
    """
    places = rows.select(F.explode(F.array(*_places(F.col("sha"), bits))).alias("place"))
    twice = places.groupBy("place").count().where("count > 1")
    words = twice.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")
    )
    found = words.toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out


def may_repeat(sha: Column, held: Broadcast, bits: int) -> Column:
    """Second pass: whether all bits of a hash are set, so that it may occur again."""

    @F.pandas_udf("boolean")
    def look_up(first: pd.Series, second: pd.Series) -> pd.Series:
        words = held.value.view(np.uint64)
        found = np.ones(len(first), bool)
        for place in (first.to_numpy(np.int64), second.to_numpy(np.int64)):
            found &= (words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
        return pd.Series(found)

    return look_up(*_places(sha, bits))


def _filter_of(rows: DataFrame, n: int) -> tuple[Broadcast, int]:
    bits = filter_bits(n)
    if n * HASHES > bits:
        warnings.warn(f"{n} rows for {bits} bits: most rows will be shuffled; raise MAX_BITS", stacklevel=3)
    return rows.sparkSession.sparkContext.broadcast(repeated_bits(rows, bits)), bits


def equal_texts(docs: DataFrame) -> DataFrame:
    """The group of equal texts of every row, dropped rows too.

    Texts are equal when identical without the characters space and 0x09-0x0D. Of a
    group the row with the most code points stays, then the one with the smallest
    `doc_id`, a null id being the largest; of rows that are the same in both, any one.
    Columns: `doc_id`, `keep_id` (id of the row that stays), `group_size`, `kept`,
    `text_sha256`. Null texts are empty; empty and blank texts are equal. Repeated rows
    count as often as they occur. Other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    rows = docs.select(
        "doc_id",
        code_points(F.col("text")).alias("n"),
        text_sha256(F.col("text")).alias("sha"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = saved(rows, "hashes")  # texts are read once; later steps see hashes only
    n = rows.count()
    held, bits = _filter_of(rows.select("sha"), n)
    marked = saved(rows.withColumn("again", may_repeat(F.col("sha"), held, bits)), "marked")
    held.destroy()
    alone = marked.where("not again").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    again = marked.where("again").drop("again")
    groups = saved(again.groupBy("sha").agg(F.count("*").alias("size"), F.min(_order()).alias("best")), "groups")
    joined = with_groups(again, groups, ["sha"], n)
    return alone.unionByName(
        joined.select(
            "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
            (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"),
        )
    )


def _order() -> Column:
    """Least for the row that stays."""
    return F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")


def without_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, as `equal_texts` keeps it, with all columns of `docs`.

    Rows that the filter lets through are never shuffled. Those it holds back are
    reduced to one row a text in each task before their shuffle. Odd rows as there.
    """
    shas = docs.select(text_sha256(F.col("text")).alias("sha"))
    shas = saved(shas, "hashes")
    held, bits = _filter_of(shas, shas.count())
    packed = docs.select(
        F.struct("*").alias("whole"),
        "doc_id",
        code_points(F.col("text")).alias("n"),
        text_sha256(F.col("text")).alias("sha"),
    )
    marked = packed.withColumn("again", may_repeat(F.col("sha"), held, bits))
    alone = marked.where("not again").select("whole.*")
    turn = F.row_number().over(Window.partitionBy("sha").orderBy(F.desc("n"), F.asc_nulls_last("doc_id")))
    best = marked.where("again").withColumn("turn", turn).where("turn = 1")
    return alone.union(best.select("whole.*"))

