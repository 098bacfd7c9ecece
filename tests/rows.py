"""Hand-written raw trips and zones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from trip_marts.schemas import GREEN, YELLOW, ZONE_SCHEMA, Service

TYPES = {
    "VendorID": "bigint",
    "pickup": "timestamp_ntz",
    "dropoff": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
}
OWN_TYPES = {
    "yellow": {"airport_fee": "double"},
    "green": {"ehail_fee": "double", "trip_type": "bigint"},
}
PLAIN = {
    "VendorID": 1,
    "pickup": datetime(2023, 1, 1, 10, 0, 0),
    "dropoff": datetime(2023, 1, 1, 10, 30, 0),
    "passenger_count": 1.0,
    "trip_distance": 5.0,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 4.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 25.8,
    "congestion_surcharge": 2.5,
    "airport_fee": 1.25,
    "ehail_fee": None,
    "trip_type": 1,
}


def raw(spark: SparkSession, service: Service, *changes: dict) -> DataFrame:
    """Raw rows of a service, each a plain trip with some values changed."""
    types = {**TYPES, **OWN_TYPES[service.taxi_type]}
    own_names = {"pickup": service.pickup, "dropoff": service.dropoff}
    schema = ", ".join(f"{own_names.get(n, n)} {t}" for n, t in types.items())
    data = [tuple({**PLAIN, **change}[n] for n in types) for change in changes]
    return spark.createDataFrame(data, schema)


def yellow(spark: SparkSession, *changes: dict) -> DataFrame:
    return raw(spark, YELLOW, *changes)


def green(spark: SparkSession, *changes: dict) -> DataFrame:
    return raw(spark, GREEN, *changes)


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            (1, "Queens", "Airport Road", "Airports"),
            (2, "Bronx", "Hill Side", "Boro Zone"),
            (3, "Queens", "Old Town", "Boro Zone"),
            (4, "Queens", "Old Town", "Yellow Zone"),
            (7, "Unknown", "N/A", "N/A"),
            (8, "N/A", "Outside", "N/A"),
            (9, None, "Nowhere", "N/A"),
        ],
        ZONE_SCHEMA,
    )
