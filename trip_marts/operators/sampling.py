"""Reduced runs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sample_limit(df: DataFrame, rows: int | None) -> DataFrame:
    """At most ``rows`` arbitrary rows; everything when it is None."""
    return df if rows is None else df.limit(rows)
