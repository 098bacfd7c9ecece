"""Code to text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trip_marts.schemas import EMPTY_PAYMENT_LABEL, PAYMENT_LABELS


def payment_label(code: Column) -> Column:
    """Label of a payment code; null and unlisted codes share one label.

    A lookup rather than a chain of comparisons, so the code, which may be a
    longer expression, is worked out once.
    """
    labels = F.create_map(*[F.lit(x) for pair in PAYMENT_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(labels, code), F.lit(EMPTY_PAYMENT_LABEL))
