"""Raw trips of one service to the canonical trip columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_marts.functions.casts import (
    amount,
    money,
    or_zero,
    safe_amount,
    safe_int,
    safe_timestamp,
)
from trip_marts.functions.keys import surrogate_key
from trip_marts.functions.labels import payment_label
from trip_marts.operators.dedup import first_per_key
from trip_marts.operators.sampling import sample_limit
from trip_marts.schemas import Service, find_field

VENDOR = "VendorID"

# Raw columns both services have, besides vendor and the two times.
SHARED_COLUMNS = [
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "RatecodeID",
    "store_and_fwd_flag",
    "extra",
    "mta_tax",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
]


def tie_break_order(service: Service) -> list[str]:
    """Every raw column the model reads apart from the key.

    Rows that tie on all of them are the same trip in every output column, so
    the one that is kept does not matter and the result is reproducible.
    """
    own = [*service.own_fees, *(["trip_type"] if service.has_trip_type else [])]
    return [service.dropoff, *SHARED_COLUMNS, *own]


def stage_trips(raw: DataFrame, service: Service, sample_rows: int | None = None) -> DataFrame:
    """One cleaned row per vendor and pickup time."""
    missing = [
        name
        for name in [VENDOR, service.pickup, *tie_break_order(service)]
        if find_field(raw, name) is None
    ]
    if missing:
        raise ValueError(f"raw {service.taxi_type} trips lack columns {missing}")

    trips = first_per_key(
        raw.where(F.col(VENDOR).isNotNull()),
        # The time first: most pairs of rows then sort by one comparison.
        [service.pickup, VENDOR],
        tie_break_order(service),
    )

    def paid(name: str) -> Column:
        return amount(trips, name).alias(name)

    # The label is built from the raw code: null has a label of its own.
    payment_code = safe_int(trips, "payment_type")
    trip_type = safe_int(trips, "trip_type") if service.has_trip_type else F.lit(1)
    columns = [
        surrogate_key(F.col(VENDOR), F.col(service.pickup)).alias("tripid"),
        safe_int(trips, VENDOR).alias("vendorid"),
        safe_int(trips, "passenger_count").alias("count_passenger"),
        safe_int(trips, "RatecodeID").alias("ratecodeid"),
        safe_int(trips, "PULocationID").alias("pickup_locationid"),
        safe_int(trips, "DOLocationID").alias("dropoff_locationid"),
        safe_timestamp(F.col(service.pickup)).alias("pickup_datetime"),
        safe_timestamp(F.col(service.dropoff)).alias("dropoff_datetime"),
        paid("trip_distance"),
        trip_type.alias("trip_type"),
        F.col("store_and_fwd_flag"),
        or_zero(payment_code).alias("payment_type"),
        payment_label(payment_code).alias("payment_type_describe"),
        paid("fare_amount"),
        paid("extra"),
        paid("mta_tax"),
        paid("tip_amount"),
        paid("tolls_amount"),
    ]
    if "ehail_fee" in service.own_fees:
        columns.append(money(or_zero(safe_amount(trips, "ehail_fee"))).alias("ehail_fee"))
    columns += [
        paid("improvement_surcharge"),
        paid("total_amount"),
        paid("congestion_surcharge"),
    ]
    if "airport_fee" in service.own_fees:
        columns.append(paid("airport_fee"))
    return sample_limit(trips.select(*columns), sample_rows)
