"""Trip fact: both services with pickup and drop-off zone names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.functions.times import month_text
from trip_marts.operators.unions import union_services, with_service
from trip_marts.plans.dimension import known_zones
from trip_marts.schemas import FACT_COLUMNS, GREEN, PICKUP_MONTH, YELLOW


def fact_trips(
    yellow: DataFrame, green: DataFrame, dim: DataFrame, by_position: bool = False
) -> DataFrame:
    """Trips whose pickup and drop-off zones are both known.

    The two zone joins carry no broadcast hint: the planner broadcasts the
    dimension while it is below ``spark.sql.autoBroadcastJoinThreshold`` and
    falls back to a skew-aware shuffle join above it.
    """
    trips = union_services(
        with_service(yellow, YELLOW.label), with_service(green, GREEN.label), by_position
    )
    for role in ("pickup", "dropoff"):
        zones = known_zones(dim).select(
            F.col("locationid").alias(f"{role}_locationid"),
            F.col("borough").alias(f"{role}_borough"),
            F.col("zone").alias(f"{role}_zone"),
        )
        trips = trips.join(zones, f"{role}_locationid", "inner")
    return trips.select(*FACT_COLUMNS)


def with_pickup_month(fact: DataFrame) -> DataFrame:
    """The fact plus the month its table is partitioned by."""
    return fact.withColumn(PICKUP_MONTH, month_text(F.col("pickup_datetime")))
