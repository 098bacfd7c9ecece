"""Hashed row keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trip_marts.schemas import SURROGATE_KEY_NULL


def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def row_hash_key(pickup: Column, dropoff: Column, location: Column, distance: Column) -> Column:
    """Key of a raw row: md5 of the parts as text, nulls as empty text.

    The distance should be a decimal, so that its text does not depend on how
    an engine prints large or small floating numbers.
    """
    parts = [pickup, dropoff, location, distance]
    return F.md5(F.concat(*[text_or_empty(part) for part in parts]))


def surrogate_key(*values: Column) -> Column:
    """Key of a cleaned row: md5 of the values joined by ``-``."""
    parts = [F.coalesce(v.cast("string"), F.lit(SURROGATE_KEY_NULL)) for v in values]
    return F.md5(F.concat_ws("-", *parts))
