"""The four marts, each one aggregation over the fact.

A trip id is never null, so trips are counted as rows; this keeps the widest
column of the fact out of every mart's scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_marts.functions.measures import (
    exact_mean,
    exact_sum,
    mean_where,
    percent_of_rows,
    ratio_of_sums,
)
from trip_marts.functions.times import (
    hour_of_day,
    minute_boundaries,
    month_start,
    weekday_number,
)
from trip_marts.operators.ranking import rank_by_count
from trip_marts.schemas import CREDIT_CARD, MONTHLY_SUMS

MIN_TIPPING_GROUP = 10


def pickup() -> Column:
    return F.col("pickup_datetime")


def dropoff() -> Column:
    return F.col("dropoff_datetime")


def trips() -> Column:
    return F.count(F.lit(1))


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue, trips and means per pickup zone, month and service."""
    sums = [exact_sum(F.col(source)).alias(name) for name, source in MONTHLY_SUMS.items()]
    return fact.groupBy(
        F.col("pickup_zone").alias("revenue_zone"),
        month_start(pickup()).alias("revenue_month"),
        "service_type",
    ).agg(
        *sums,
        trips().alias("total_monthly_trips"),
        F.avg("count_passenger").alias("avg_monthly_count_passenger"),
        exact_mean(F.col("trip_distance")).alias("avg_monthly_trip_distance"),
    )


def hourly_operation(fact: DataFrame) -> DataFrame:
    """Trips, duration, distance, speed and revenue rate by month, weekday, hour."""
    minutes = F.col("minutes")
    moving = minutes > 0
    return (
        fact.where((F.col("trip_distance") > 0) & (dropoff() > pickup()))
        .select(
            "service_type",
            month_start(pickup()).alias("report_month"),
            weekday_number(pickup()).alias("day_of_week"),
            hour_of_day(pickup()).alias("hour_of_day"),
            "trip_distance",
            "total_amount",
            minute_boundaries(pickup(), dropoff()).alias("minutes"),
        )
        .groupBy("service_type", "report_month", "day_of_week", "hour_of_day")
        .agg(
            trips().alias("total_trips"),
            F.avg("minutes").alias("avg_trip_duration_minutes"),
            exact_mean(F.col("trip_distance")).alias("avg_trip_distance_miles"),
            mean_where(
                moving, F.col("trip_distance").cast("double") / (minutes / F.lit(60.0))
            ).alias("avg_speed_mph"),
            mean_where(moving, F.col("total_amount").cast("double") / minutes).alias(
                "avg_revenue_per_minute"
            ),
        )
    )


def in_display_order(hourly: DataFrame) -> DataFrame:
    """The hourly mart sorted for reading; a stored table has no order."""
    keys = ["service_type", "report_month", "day_of_week", "hour_of_day"]
    return hourly.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def od_routes(fact: DataFrame) -> DataFrame:
    """Trips, rank, means and revenue per mile of each route and month."""
    routes = (
        fact.where(F.col("pickup_zone").isNotNull() & F.col("dropoff_zone").isNotNull())
        .groupBy(
            "service_type",
            month_start(pickup()).alias("report_month"),
            "pickup_zone",
            "dropoff_zone",
        )
        .agg(
            trips().alias("trip_count"),
            exact_mean(F.col("trip_distance")).alias("avg_distance"),
            exact_mean(F.col("total_amount")).alias("avg_cost_per_trip"),
            ratio_of_sums(F.col("total_amount"), F.col("trip_distance")).alias("revenue_per_mile"),
        )
    )
    return routes.withColumn(
        "route_popularity_rank", rank_by_count(["service_type", "report_month"], "trip_count")
    )


def tipping(
    fact: DataFrame,
    credit_label: str = CREDIT_CARD,
    group_by: tuple[str, ...] = ("service_type", "pickup_zone", "payment_type_describe"),
) -> DataFrame:
    """Tip counts, share and means of each group of more than ten paid trips."""
    tipped = F.col("tip_amount") > 0
    by_card = (F.col("fare_amount") > 0) & (F.col("payment_type_describe") == credit_label)
    tip, fare = F.col("tip_amount").cast("double"), F.col("fare_amount").cast("double")
    return (
        fact.where(F.col("total_amount") > 0)
        .groupBy(*group_by)
        .agg(
            trips().alias("total_trips"),
            F.count_if(tipped).alias("count_trips_with_tip"),
            percent_of_rows(tipped).alias("percentage_trips_with_tip"),
            exact_mean(F.col("tip_amount")).alias("avg_tip_amount"),
            mean_where(by_card, tip / fare * 100).alias("avg_tip_percentage"),
        )
        .where(F.col("total_trips") > MIN_TIPPING_GROUP)
    )
