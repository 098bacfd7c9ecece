"""Raw trips and zones derived from the driver's order and event tables.

An order line is a trip: its supplier is the vendor, the order date the pickup,
the ship date the drop-off; supplier and customer nations are the two zones.
Lines with status O are yellow trips, lines with status F green ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trip_marts.functions.casts import money, money_from_double
from trip_marts.plans.dimension import dim_zone
from trip_marts.plans.fact import fact_trips
from trip_marts.plans.staging import stage_trips
from trip_marts.schemas import GREEN, YELLOW, Service

LINE_STATUS = {YELLOW.taxi_type: "O", GREEN.taxi_type: "F"}


SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the files only the first time."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def share_of_fare(rate: str) -> Column:
    """Price times a rate, both made decimals first so that it is exact."""
    return money(money_from_double(F.col("l_extendedprice")) * money_from_double(F.col(rate)))


def raw_trips(spark: SparkSession, sf_dir: str, service: Service) -> DataFrame:
    """The raw table of one service, with that service's own column names."""
    lines = table(spark, sf_dir, "lineitem").where(
        F.col("l_linestatus") == LINE_STATUS[service.taxi_type]
    )
    supplier = table(spark, sf_dir, "supplier")
    customer = table(spark, sf_dir, "customer")
    # The narrow orders meet their customers first, so that no shuffle of the
    # lines is needed for it, however many customers there are.
    orders = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    fare = money_from_double(F.col("l_extendedprice"))
    tip, tax = share_of_fare("l_discount"), share_of_fare("l_tax")
    if service is YELLOW:
        own = [F.lit(1.25).alias("airport_fee")]
    else:
        own = [F.lit(0.5).alias("ehail_fee"), F.lit(1).alias("trip_type")]
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_suppkey").alias("VendorID"),
            F.col("o_orderdate").alias(service.pickup),
            F.col("l_shipdate").alias(service.dropoff),
            F.col("l_linenumber").cast("double").alias("passenger_count"),
            F.lit(1.0).alias("RatecodeID"),
            F.col("s_nationkey").alias("PULocationID"),
            F.col("c_nationkey").alias("DOLocationID"),
            F.col("l_quantity").alias("trip_distance"),
            F.col("l_returnflag").alias("store_and_fwd_flag"),
            F.substring("o_orderpriority", 1, 1).alias("payment_type"),
            fare.alias("fare_amount"),
            F.lit(0.75).alias("extra"),
            tax.alias("mta_tax"),
            tip.alias("tip_amount"),
            money_from_double(F.col("l_discount")).alias("tolls_amount"),
            F.lit(0.3).alias("improvement_surcharge"),
            money(fare + tip + tax).alias("total_amount"),
            F.lit(2.5).alias("congestion_surcharge"),
            *own,
        )
    )


def staged(spark: SparkSession, sf_dir: str, service: Service) -> DataFrame:
    return stage_trips(raw_trips(spark, sf_dir, service), service)


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones; one region stands for the unknown borough."""
    borough = F.when(F.col("r_name") == "MIDDLE EAST", "Unknown").otherwise(F.col("r_name"))
    service_zone = F.when(F.col("r_name") == "EUROPE", "Boro Zone").otherwise("Yellow Zone")
    return (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("LocationID"),
            borough.alias("Borough"),
            F.col("n_name").alias("Zone"),
            service_zone.alias("service_zone"),
        )
    )


def fact(spark: SparkSession, sf_dir: str, by_position: bool = False) -> DataFrame:
    return fact_trips(
        staged(spark, sf_dir, YELLOW),
        staged(spark, sf_dir, GREEN),
        dim_zone(raw_zones(spark, sf_dir)),
        by_position,
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips with times to the microsecond.

    The value gives the minutes under way, so each row stands for itself and no
    user's events have to meet in one task. Error events run backwards.
    """
    value = money_from_double(F.col("value"))
    millis = (value * 60000).cast("bigint")
    backwards = F.col("event_type") == "error"
    distance = money(F.col("user_id").cast("decimal(18,3)") * F.lit("0.125").cast("decimal(4,3)"))
    dropoff = F.timestamp_add("MILLISECOND", F.when(backwards, -millis).otherwise(millis), "ts")
    return table(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.when(F.col("event_type").isin("click", "view", "error"), YELLOW.label)
        .otherwise(GREEN.label)
        .alias("service_type"),
        F.col("ts").alias("pickup_datetime"),
        dropoff.alias("dropoff_datetime"),
        distance.alias("trip_distance"),
        money(distance * F.lit("2.5").cast("decimal(2,1)") + value).alias("total_amount"),
    )
