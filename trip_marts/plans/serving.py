"""Aggregates behind the charts, each a small result computed from a mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_marts.functions.measures import exact_sum, weighted_mean

TOTAL = "revenue_monthly_total_amount"
TOP_ROWS = 10


def kpi_totals(monthly: DataFrame) -> DataFrame:
    """Total revenue, total trips and the unweighted mean of mean distances."""
    return monthly.agg(
        exact_sum(F.col(TOTAL)).alias("total_revenue"),
        F.sum("total_monthly_trips").alias("total_trips"),
        F.avg("avg_monthly_trip_distance").alias("avg_distance"),
    )


def weighted_distance(monthly: DataFrame) -> DataFrame:
    """Mean distance with each zone and month weighted by its trips."""
    trips = F.col("total_monthly_trips")
    return monthly.agg(
        (
            F.sum(F.col("avg_monthly_trip_distance") * trips)
            / F.nullif(F.sum(trips).cast("double"), F.lit(0.0))
        ).alias("avg_distance")
    )


def _mean(name: str, trips: str, weighted: bool) -> Column:
    """Mean of a mart's means, each counting once or as often as its row has trips."""
    return weighted_mean(F.col(name), F.col(trips)) if weighted else F.avg(name)


def revenue_trend(monthly: DataFrame) -> DataFrame:
    """Revenue by month and service; rows without either are left out."""
    return (
        monthly.dropna(subset=["revenue_month", "service_type"])
        .groupBy("revenue_month", "service_type")
        .agg(exact_sum(F.col(TOTAL)).alias(TOTAL))
    )


def top_zones(monthly: DataFrame, rows: int = TOP_ROWS) -> DataFrame:
    """Zones of highest revenue, equal ones by name."""
    return (
        monthly.dropna(subset=["revenue_zone"])
        .groupBy("revenue_zone")
        .agg(exact_sum(F.col(TOTAL)).alias(TOTAL))
        .orderBy(F.desc(TOTAL), "revenue_zone")
        .limit(rows)
    )


def revenue_levels(monthly: DataFrame) -> DataFrame:
    """Totals, trend and zones from one aggregation of the mart.

    ``level`` tells the rows apart: ``total`` has no key, ``trend`` month and service,
    ``zone`` the zone. Keys that a level does not group by are null; a null key of a level
    itself is a group of its own there.
    """
    by = {"zone": ["revenue_zone"], "trend": ["revenue_month", "service_type"], "total": []}
    keys = [k for own in by.values() for k in own]
    # a bit of the id for each key, set where the level leaves the key out
    ids = {sum(1 << (len(keys) - 1 - keys.index(k)) for k in keys if k not in own): n for n, own in by.items()}
    level = F.col("grouping")
    name = F.lit(None).cast("string")
    for number, text in ids.items():
        name = F.when(level == number, text).otherwise(name)
    sums = monthly.groupingSets([[F.col(k) for k in own] for own in by.values()], *keys).agg(
        F.grouping_id().alias("grouping"),
        exact_sum(F.col(TOTAL)).alias(TOTAL),
        F.sum("total_monthly_trips").alias("total_trips"),
    )
    return sums.select(name.alias("level"), *keys, TOTAL, "total_trips")


def service_choices(hourly: DataFrame) -> DataFrame:
    return hourly.select("service_type").distinct()


def weekday_hour_heatmap(hourly: DataFrame, service: str) -> DataFrame:
    """Trips by weekday and hour of one service."""
    return (
        hourly.where(F.col("service_type") == service)
        .dropna(subset=["day_of_week", "hour_of_day"])
        .groupBy("day_of_week", "hour_of_day")
        .agg(F.sum("total_trips").alias("total_trips"))
    )


def weekday_hour_grid(hourly: DataFrame, service: str) -> DataFrame:
    """Trips of one service as a grid: a row for each weekday, columns ``h00`` to ``h23``.

    The hours are fixed, so the data is read once and every hour has its column; null
    stands for no trips.
    """
    return (
        weekday_hour_heatmap(hourly, service)
        .groupBy("day_of_week")
        .pivot("hour_of_day", list(range(24)))
        .agg(F.sum("total_trips"))
        .withColumnsRenamed({str(hour): f"h{hour:02d}" for hour in range(24)})
    )


def speed_by_hour(hourly: DataFrame, service: str, weighted: bool = False) -> DataFrame:
    """Mean of the mean speeds by hour of one service; ``weighted`` by trips."""
    return (
        hourly.where(F.col("service_type") == service)
        .dropna(subset=["hour_of_day"])
        .groupBy("hour_of_day")
        .agg(_mean("avg_speed_mph", "total_trips", weighted).alias("avg_speed_mph"))
    )


def top_routes(routes: DataFrame, rows: int = TOP_ROWS, weighted: bool = False) -> DataFrame:
    """Routes of most trips over all months and services, equal ones by name.

    Their cost is the mean of the months' means, ``weighted`` by the trips of each.
    """
    return (
        routes.groupBy("pickup_zone", "dropoff_zone")
        .agg(
            F.sum("trip_count").alias("total_trips"),
            _mean("avg_cost_per_trip", "trip_count", weighted).alias("avg_cost"),
        )
        .orderBy(F.desc("total_trips"), "pickup_zone", "dropoff_zone")
        .limit(rows)
    )


def tip_by_payment(tips: DataFrame, weighted: bool = False) -> DataFrame:
    """Mean tip percentage and trips by payment label, most trips first.

    The percentage is the mean of the groups' means, ``weighted`` by the trips of each.
    """
    return (
        tips.where(F.col("payment_type_describe").isNotNull())
        .groupBy("payment_type_describe")
        .agg(
            _mean("avg_tip_percentage", "total_trips", weighted).alias("tip_pct"),
            F.sum("total_trips").alias("trips"),
        )
        .orderBy(F.desc("trips"), "payment_type_describe")
    )
