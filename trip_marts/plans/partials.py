"""The tipping mart from stored monthly states.

A state holds counts and sums of one group and month: everything the mart's shares and
means are quotients of. States of different months add up, so a build reads the
fact's changed months only and rolls up the small table of states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.functions.measures import exact_sum
from trip_marts.plans.marts import MIN_TIPPING_GROUP, trips
from trip_marts.schemas import CREDIT_CARD, PICKUP_MONTH

LABEL = "payment_type_describe"
TIPPING_KEYS = ("service_type", "pickup_zone", LABEL)


def tipping_state(fact: DataFrame, group_by: Sequence[str] = TIPPING_KEYS) -> DataFrame:
    """Counts and sums of paid trips by group, payment label and pickup month.

    The label is always part of the group, so that the choice of the card label is
    left to the roll-up. Amounts add up exactly; only the tip ratios are floating.
    """
    tip, fare = F.col("tip_amount"), F.col("fare_amount")
    ratio = F.when(fare > 0, tip.cast("double") / fare.cast("double") * 100)
    return (
        fact.where(F.col("total_amount") > 0)
        .groupBy(*dict.fromkeys([*group_by, LABEL, PICKUP_MONTH]))
        .agg(
            trips().alias("trips"),
            F.count_if(tip > 0).alias("tipped_trips"),
            exact_sum(tip).alias("tip_sum"),
            F.count(tip).alias("tip_count"),
            F.sum(ratio).alias("ratio_sum"),
            F.count(ratio).alias("ratio_count"),
        )
    )


def tipping_from_state(
    state: DataFrame, credit_label: str = CREDIT_CARD, group_by: Sequence[str] = TIPPING_KEYS
) -> DataFrame:
    """The tipping mart of all months in ``state``, as ``marts.tipping`` has it."""
    by_card = F.col(LABEL) == credit_label
    total = F.sum("trips")
    return (
        state.groupBy(*group_by)
        .agg(
            total.alias("total_trips"),
            F.sum("tipped_trips").alias("count_trips_with_tip"),
            (F.sum("tipped_trips") * F.lit(100.0) / total).alias("percentage_trips_with_tip"),
            (F.sum("tip_sum").cast("double") / F.sum("tip_count")).alias("avg_tip_amount"),
            (
                F.sum(F.when(by_card, F.col("ratio_sum")))
                / F.sum(F.when(by_card, F.col("ratio_count")))
            ).alias("avg_tip_percentage"),
        )
        .where(F.col("total_trips") > MIN_TIPPING_GROUP)
    )
