"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_NUMBER = "_row_number"


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key in ``order_by``, nulls last, null keys grouped.

    The filter on the row number lets Spark keep one row per key in every map
    task before the shuffle, so a key shared by much of the data reaches its
    reduce task as at most one row per map task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    window = Window.partitionBy(*keys).orderBy(*[c.asc_nulls_last() for c in order])
    return (
        df.withColumn(ROW_NUMBER, F.row_number().over(window))
        .where(F.col(ROW_NUMBER) == 1)
        .drop(ROW_NUMBER)
    )
