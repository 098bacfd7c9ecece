"""Column maps, fixed values and schemas shared by all layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = "decimal(18,3)"
MONEY_SUM = "decimal(38,3)"
TIMESTAMP = "timestamp_ntz"

PICKUP_MONTH = "pickup_month"
ROW_KEY = "unique_row_id"
SOURCE_FILE = "source_file"

# Payment codes and their labels, as text.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
EMPTY_PAYMENT_LABEL = "EMPTY"
CREDIT_CARD = PAYMENT_LABELS[1]
# The spelling the tipping mart was first written with; no label matches it,
# so passing it to the mart gives the always-null tip percentage.
CREDIT_CARD_AS_WRITTEN = "Credit Card"
ACCEPTED_PAYMENT_CODES = [1, 2, 3, 4, 5, 6]

# Fixed value: text that stands for a null part of a surrogate key.
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"

UNKNOWN_BOROUGH = "Unknown"
SAMPLE_LIMIT = 100

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Service:
    """How one taxi service names its raw columns."""

    taxi_type: str
    label: str
    pickup: str
    dropoff: str
    # Fee columns only this service has.
    own_fees: tuple[str, ...] = ()
    # Services without a trip type column get a constant.
    has_trip_type: bool = False


YELLOW = Service(
    "yellow", "Yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime", ("airport_fee",)
)
GREEN = Service(
    "green",
    "Green",
    "lpep_pickup_datetime",
    "lpep_dropoff_datetime",
    ("ehail_fee",),
    has_trip_type=True,
)
SERVICES = {service.taxi_type: service for service in (YELLOW, GREEN)}


def service_for(taxi_type: str) -> Service:
    """The named service; any other type falls back to plain column names."""
    known = SERVICES.get(taxi_type)
    if known is not None:
        return known
    return Service(taxi_type, taxi_type.capitalize(), "pickup_datetime", "dropoff_datetime")


# Measures summed by the monthly mart, in output order.
MONTHLY_SUMS = {
    "revenue_monthly_fare": "fare_amount",
    "revenue_monthly_extra": "extra",
    "revenue_monthly_mta_tax": "mta_tax",
    "revenue_monthly_tip_amount": "tip_amount",
    "revenue_monthly_tolls_amount": "tolls_amount",
    "revenue_monthly_airport_fee": "airport_fee",
    "revenue_monthly_improvement_surcharge": "improvement_surcharge",
    "revenue_monthly_congestion_surcharge": "congestion_surcharge",
    "revenue_monthly_total_amount": "total_amount",
}

FACT_COLUMNS = [
    "tripid",
    "vendorid",
    "service_type",
    "ratecodeid",
    "pickup_locationid",
    "pickup_borough",
    "pickup_zone",
    "dropoff_locationid",
    "dropoff_borough",
    "dropoff_zone",
    "pickup_datetime",
    "dropoff_datetime",
    "store_and_fwd_flag",
    "count_passenger",
    "trip_distance",
    "trip_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "airport_fee",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "payment_type",
    "payment_type_describe",
]


def find_field(df: DataFrame, name: str) -> T.StructField | None:
    """The field called ``name`` in any letter case, or None."""
    wanted = name.lower()
    return next((f for f in df.schema.fields if f.name.lower() == wanted), None)
