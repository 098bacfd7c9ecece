"""Joins of rows with facts about their group, however large one group is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group of more than this share of the rows, and of more than `LEAST_LARGE` rows, is large.
LARGE_SHARE = 1e-4
LEAST_LARGE = 100


def with_groups(rows: DataFrame, groups: DataFrame, keys: list[str], n: int) -> DataFrame:
    """`rows` with the columns of their group; `groups` has one row for each key and its `size`.

    Keys must not be null. Of `n` rows at most 1 / `LARGE_SHARE` groups are large, so those
    are broadcast and their rows stay where they are; rows of all other groups are
    shuffled, of which no key has more than the limit.
    """
    limit = max(LEAST_LARGE, int(n * LARGE_SHARE))
    large = F.broadcast(groups.where(F.col("size") > limit))
    small = groups.where(F.col("size") <= limit)
    in_large = rows.join(large, keys)
    others = rows.join(F.broadcast(groups.where(F.col("size") > limit).select(*keys)), keys, "left_anti")
    return in_large.unionByName(others.join(small, keys))
