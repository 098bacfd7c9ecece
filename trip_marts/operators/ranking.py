"""Rank within groups of an aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def rank_by_count(groups: Sequence[str], count: str) -> Column:
    """Rank 1 for the largest count of a group; ties share a rank.

    For aggregated rows only: a group then holds one row per route, which the
    number of zones bounds however many trips there are.
    """
    return F.rank().over(Window.partitionBy(*groups).orderBy(F.desc(count)))
