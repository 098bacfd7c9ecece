"""Aggregates with exact sums and floating quotients.

Amounts are summed as decimals, so totals do not depend on row order; only the
finished sums become doubles for a division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trip_marts.schemas import MONEY_SUM


def exact_sum(amount: Column) -> Column:
    return F.sum(amount).cast(MONEY_SUM)


def exact_mean(amount: Column) -> Column:
    """Mean of a decimal column as a double, null for no values."""
    return F.sum(amount).cast("double") / F.count(amount)


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    """Quotient of two sums, null when the lower one is zero."""
    return F.sum(numerator).cast("double") / F.nullif(
        F.sum(denominator).cast("double"), F.lit(0.0)
    )


def percent_of_rows(condition: Column) -> Column:
    """Share of rows meeting the condition, 0 to 100."""
    return F.count_if(condition) * F.lit(100.0) / F.count(F.lit(1))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of a floating value by whole weights; rows without a value have no weight.

    Null where no row has a value or all weights are zero.
    """
    weights = F.sum(F.when(value.isNotNull(), weight)).cast("double")
    return F.sum(value * weight) / F.nullif(weights, F.lit(0.0))


def mean_where(condition: Column, value: Column) -> Column:
    """Mean of a floating value over the rows meeting the condition."""
    return F.avg(F.when(condition, value))
