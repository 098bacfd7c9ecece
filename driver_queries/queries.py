"""One query per operator, each over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries.scratch import scratch_folder, scratch_lake
from driver_queries.trips import event_trips, fact, raw_trips, raw_zones, staged, table
from trip_marts.functions.casts import (
    money,
    money_from_double,
    or_zero,
    safe_amount,
    safe_int,
    safe_timestamp,
)
from trip_marts.functions.keys import surrogate_key
from trip_marts.functions.labels import payment_label
from trip_marts.functions.measures import exact_sum, ratio_of_sums
from trip_marts.functions.times import (
    hour_of_day,
    minute_boundaries,
    month_start,
    month_text,
    weekday_number,
)
from trip_marts.operators import quality
from trip_marts.operators.bucketed import Buckets, upsert_bucketed
from trip_marts.operators.dedup import first_per_key
from trip_marts.operators.incremental import newer_rows, table_watermarks, watermarks
from trip_marts.operators.membership import KeyFilter, upsert_filtered
from trip_marts.operators.observed import WrittenChecks
from trip_marts.operators.unions import union_services, with_service
from trip_marts.operators.upsert import matched_rows, upsert_rows, upsert_table
from trip_marts.plans import marts, serving
from trip_marts.plans.dimension import dim_zone, known_zones
from trip_marts.plans.fact import with_pickup_month
from trip_marts.plans.pipeline import FACT_PARTITIONS, Lake, in_months, refresh_tipping
from trip_marts.plans.staging import VENDOR, stage_trips, tie_break_order
from trip_marts.schemas import CREDIT_CARD_AS_WRITTEN, GREEN, MONEY, PICKUP_MONTH, SAMPLE_LIMIT, YELLOW
from trip_marts.sources.files import (
    MonthBatch,
    as_batch,
    in_month,
    land_months,
    land_rows,
    scan_landed,
    scan_parquet,
    scan_zones,
)
from trip_marts.sources.snapshots import publish_snapshot, read_snapshot
from trip_marts.sources.tables import append_rows, count_rows, refresh_table, replace_exactly, shuffles_removed
from trip_marts.sources.versioned import VersionedTable, upsert_versioned
from trip_marts.streaming.arrivals import follow_arrivals

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()
RELOADED_MONTH = MonthBatch("yellow", 1997, 5)
LOADED_BEFORE = "1999-01-01"
CORRECTED_MONTH = "1997-05"


def query(name: str) -> Callable[[Query], Query]:
    """Register a function under the query's name."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def shown(df: DataFrame, rounded: tuple[str, ...] = ()) -> DataFrame:
    """Amounts as doubles; means of floating values to six places.

    A mean of floating values depends in its last bits on the order of the
    rows, which neither engine fixes. All other values are exact.
    """
    columns = []
    for f in df.schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            value = value.cast("double")
        if f.name in rounded:
            value = F.round(value, 6)
        columns.append(value.alias(f.name))
    return df.select(*columns)


# Scans and sources


@query("scan_parquet")
def scan_parquet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scan_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return shown(
        lines.groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("total_rows"),
            exact_sum(money_from_double(F.col("l_quantity"))).alias("quantity"),
            exact_sum(money_from_double(F.col("l_extendedprice"))).alias("price"),
        )
    )


@query("scan_union_by_name")
def scan_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with different columns read as one table."""
    both = scan_parquet(spark, f"{sf_dir}/customer.parquet", f"{sf_dir}/supplier.parquet")
    return both.select("c_custkey", "c_name", "c_nationkey", "s_suppkey", "s_name", "s_nationkey")


@query("month_partition_scan")
def month_partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = RELOADED_MONTH
    return (
        table(spark, sf_dir, "orders")
        .where(in_month(F.col("o_orderdate"), batch))
        .select("o_orderkey", "o_custkey", "o_orderdate", F.lit(batch.source_key).alias("file_key"))
    )


@query("table_counts")
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        count_rows(table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "total_rows")
        for name in TABLES
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


@query("source_lineage")
def source_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file they were read from."""
    path = F.col("_metadata.file_path")
    return (
        table(spark, sf_dir, "lineitem")
        .select(F.substring_index(path, "/", -1).alias("source_file"))
        .groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("total_rows"))
    )


@query("temp_view")
def temp_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch registered as a view and read back by SQL."""
    table(spark, sf_dir, "orders").createOrReplaceTempView("current_load")
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS total_rows, max(o_orderdate) AS last_order "
        "FROM current_load GROUP BY o_orderstatus"
    )


@query("schema_only")
def schema_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of a raw table without its rows, next to the row count."""
    orders = table(spark, sf_dir, "orders")
    empty = count_rows(orders.limit(0)).select(F.lit("schema only").alias("what"), "total_rows")
    return empty.unionByName(count_rows(orders).select(F.lit("loaded").alias("what"), "total_rows"))


# Scalar operators


@query("row_hash_key")
def row_hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = as_batch(raw_trips(spark, sf_dir, YELLOW), "yellow", source_file="yellow")
    return batch.select(
        "unique_row_id", "source_file", "pickup_month", "PULocationID", "trip_distance"
    )


@query("surrogate_key")
def surrogate_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of vendor and pickup, and of a pair whose second part may be null."""
    trips = raw_trips(spark, sf_dir, YELLOW)
    flag = F.nullif(F.col("store_and_fwd_flag"), F.lit("N"))
    return trips.select(
        VENDOR,
        F.col(YELLOW.pickup).alias("pickup_datetime"),
        surrogate_key(F.col(VENDOR), F.col(YELLOW.pickup)).alias("tripid"),
        surrogate_key(F.col(VENDOR), flag).alias("flag_key"),
    )


@query("safe_cast_int")
def safe_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumns(
        {
            "price_text": F.col("p_retailprice").cast("string"),
            "price_money": money_from_double(F.col("p_retailprice")),
            "half": F.col("p_size") / F.lit(2.0),
        }
    )
    return parts.select(
        "p_partkey",
        safe_int(parts, "p_retailprice").alias("from_double"),
        safe_int(parts, "price_text").alias("from_text"),
        safe_int(parts, "price_money").alias("from_decimal"),
        safe_int(parts, "half").alias("from_half"),
        safe_int(parts, "p_name").alias("from_word"),
    )


@query("safe_cast_timestamp")
def safe_cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        safe_timestamp(F.col("ts").cast("string")).alias("from_text"),
        safe_timestamp(F.col("event_type")).alias("from_word"),
    )


@query("cast_decimal")
def cast_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    fare = money_from_double(F.col("l_extendedprice"))
    tip = money(fare * money_from_double(F.col("l_discount")))
    return shown(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey",
            "l_linenumber",
            fare.alias("fare_amount"),
            tip.alias("tip_amount"),
        )
    )


@query("coalesce_default")
def coalesce_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "code": F.substring("o_orderpriority", 1, 1),
            "word": F.substring("o_orderpriority", 3, 20),
        }
    )
    return shown(
        orders.select(
            "o_orderkey",
            or_zero(safe_int(orders, "code")).alias("code"),
            or_zero(safe_int(orders, "word")).alias("no_code"),
            or_zero(safe_amount(orders, "o_totalprice")).alias("amount"),
            or_zero(safe_amount(orders, "word")).cast(MONEY).alias("no_amount"),
        )
    )


@query("payment_label")
def payment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = raw_trips(spark, sf_dir, YELLOW)
    code = F.nullif(safe_int(trips, "payment_type"), F.lit(4))
    return (
        trips.select(code.alias("code"), payment_label(code).alias("label"))
        .groupBy("code", "label")
        .agg(F.count(F.lit(1)).alias("trips"))
    )


@query("month_trunc")
def month_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", month_start(F.col("o_orderdate")).alias("month_start")
    )


@query("time_parts")
def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        weekday_number(ts).alias("day_of_week"),
        hour_of_day(ts).alias("hour_of_day"),
    )


@query("minute_boundaries")
def minute_boundary_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = minute_boundaries(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return event_trips(spark, sf_dir).select(
        "event_id", "pickup_datetime", "dropoff_datetime", minutes.alias("minutes")
    )


# Staging, dimension, fact


@query("dedup_first")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = raw_trips(spark, sf_dir, GREEN)
    first = first_per_key(trips, [VENDOR, GREEN.pickup], tie_break_order(GREEN))
    return shown(
        first.select(
            VENDOR,
            F.col(GREEN.pickup).alias("pickup_datetime"),
            F.col(GREEN.dropoff).alias("dropoff_datetime"),
            "fare_amount",
            "trip_distance",
        )
    )


@query("stage_trips")
def stage_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(staged(spark, sf_dir, YELLOW))


@query("stage_trips_green")
def stage_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(staged(spark, sf_dir, GREEN))


@query("sample_limit")
def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of a reduced staging run of each service."""
    samples = [
        with_service(
            stage_trips(raw_trips(spark, sf_dir, service), service, SAMPLE_LIMIT), service.label
        )
        for service in (YELLOW, GREEN)
    ]
    return (
        union_services(*samples)
        .groupBy("service_type")
        .agg(F.count(F.lit(1)).alias("sampled_trips"))
    )


@query("dim_zone")
def zone_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zone(raw_zones(spark, sf_dir))


@query("known_zones")
def known_zone_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_zones(dim_zone(raw_zones(spark, sf_dir)))


def unioned(spark: SparkSession, sf_dir: str, by_position: bool) -> DataFrame:
    return union_services(
        with_service(staged(spark, sf_dir, YELLOW), YELLOW.label),
        with_service(staged(spark, sf_dir, GREEN), GREEN.label),
        by_position,
    )


@query("union_services")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(unioned(spark, sf_dir, by_position=False))


@query("union_services_by_position")
def union_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union as first written: the green fees land in the wrong columns."""
    return shown(unioned(spark, sf_dir, by_position=True))


@query("fact_trips")
def trip_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(fact(spark, sf_dir))


# Marts


@query("monthly_zone_revenue")
def monthly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(marts.monthly_zone_revenue(fact(spark, sf_dir)))


@query("monthly_zone_revenue_by_position")
def monthly_zone_revenue_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart over the fact as first written."""
    return shown(marts.monthly_zone_revenue(fact(spark, sf_dir, by_position=True)))


HOURLY_MEANS = ("avg_speed_mph", "avg_revenue_per_minute")


@query("hourly_operation")
def hourly_operation(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = marts.hourly_operation(event_trips(spark, sf_dir))
    return marts.in_display_order(shown(hourly, HOURLY_MEANS))


@query("hourly_operation_orders")
def hourly_operation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly mart over the trip fact, whose trips last days."""
    return shown(marts.hourly_operation(fact(spark, sf_dir)), HOURLY_MEANS)


@query("od_routes")
def od_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(marts.od_routes(fact(spark, sf_dir)))


@query("revenue_per_unit")
def revenue_per_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotient of sums per zone; one payment label has no distance at all."""
    distance = F.when(F.col("payment_type_describe") == "Cash", 0).otherwise(
        F.col("trip_distance")
    )
    return (
        fact(spark, sf_dir)
        .groupBy("pickup_zone", "payment_type_describe")
        .agg(ratio_of_sums(F.col("total_amount"), distance).alias("revenue_per_mile"))
    )


@query("tipping")
def tipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(marts.tipping(fact(spark, sf_dir)), ("avg_tip_percentage",))


@query("tipping_as_written")
def tipping_as_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart with the label spelling that matches no trip."""
    return shown(marts.tipping(fact(spark, sf_dir), credit_label=CREDIT_CARD_AS_WRITTEN))


@query("having_min_group")
def having_min_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tipping mart by route, where many groups are too small to keep."""
    keys = ("service_type", "pickup_zone", "dropoff_zone", "payment_type_describe")
    return shown(marts.tipping(fact(spark, sf_dir), group_by=keys), ("avg_tip_percentage",))


# Serving


@query("kpi_totals")
def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = marts.monthly_zone_revenue(fact(spark, sf_dir))
    return shown(serving.kpi_totals(monthly), ("avg_distance",))


@query("weighted_distance")
def weighted_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = marts.monthly_zone_revenue(fact(spark, sf_dir))
    return shown(serving.weighted_distance(monthly), ("avg_distance",))


@query("revenue_trend")
def revenue_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(serving.revenue_trend(marts.monthly_zone_revenue(fact(spark, sf_dir))))


@query("top_zones")
def top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(serving.top_zones(marts.monthly_zone_revenue(fact(spark, sf_dir))))


@query("service_choices")
def service_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.service_choices(marts.hourly_operation(event_trips(spark, sf_dir)))


@query("weekday_hour_heatmap")
def weekday_hour_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = marts.hourly_operation(event_trips(spark, sf_dir))
    return serving.weekday_hour_heatmap(hourly, YELLOW.label)


@query("weekday_hour_grid")
def weekday_hour_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = marts.hourly_operation(event_trips(spark, sf_dir))
    return serving.weekday_hour_grid(hourly, YELLOW.label)


@query("revenue_levels")
def revenue_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals, trend and zones in one pass over the monthly mart."""
    return shown(serving.revenue_levels(marts.monthly_zone_revenue(fact(spark, sf_dir))))


@query("speed_by_hour")
def speed_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = marts.hourly_operation(event_trips(spark, sf_dir))
    return shown(serving.speed_by_hour(hourly, YELLOW.label), ("avg_speed_mph",))


@query("speed_by_hour_weighted")
def speed_by_hour_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = marts.hourly_operation(event_trips(spark, sf_dir))
    return shown(serving.speed_by_hour(hourly, YELLOW.label, weighted=True), ("avg_speed_mph",))


@query("top_routes")
def top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(serving.top_routes(marts.od_routes(fact(spark, sf_dir))), ("avg_cost",))


@query("top_routes_weighted")
def top_routes_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    routes = marts.od_routes(fact(spark, sf_dir))
    return shown(serving.top_routes(routes, weighted=True), ("avg_cost",))


@query("tip_by_payment")
def tip_by_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(serving.tip_by_payment(marts.tipping(fact(spark, sf_dir))), ("tip_pct",))


@query("tip_by_payment_weighted")
def tip_by_payment_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    tips = marts.tipping(fact(spark, sf_dir))
    return shown(serving.tip_by_payment(tips, weighted=True), ("tip_pct",))


# Upsert and incremental load


def table_and_reload(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw yellow table, and one of its months loaded again with new fares."""
    trips = as_batch(raw_trips(spark, sf_dir, YELLOW), "yellow", source_file="first load")
    again = (
        raw_trips(spark, sf_dir, YELLOW)
        .where(in_month(F.col(YELLOW.pickup), RELOADED_MONTH))
        .withColumn("fare_amount", money(F.col("fare_amount") + 10))
    )
    return trips, as_batch(again, "yellow", source_file="second load")


RAW_SHOWN = ["unique_row_id", "source_file", "VendorID", "fare_amount", "pickup_month"]


@query("semi_join_reloaded")
def semi_join_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, batch = table_and_reload(spark, sf_dir)
    return shown(matched_rows(trips, batch, ["unique_row_id"]).select(*RAW_SHOWN))


@query("keyed_upsert")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, batch = table_and_reload(spark, sf_dir)
    return shown(upsert_rows(trips, batch).select(*RAW_SHOWN))


@query("incremental_watermark")
def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows above the high-water mark that an earlier load left behind."""
    trips = fact(spark, sf_dir)
    loaded = trips.where(F.col("pickup_datetime") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    return newer_rows(trips, watermarks(loaded)).select("tripid", "service_type", "pickup_datetime")


@query("landed_months")
def landed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips of every month landed, and the reloaded month read back by directory."""
    landing = scratch_folder(spark)
    for service in (YELLOW, GREEN):
        rows, pickup = raw_trips(spark, sf_dir, service), F.col(service.pickup)
        batch = MonthBatch(service.taxi_type, RELOADED_MONTH.year, RELOADED_MONTH.month)
        following = MonthBatch.of(service.taxi_type, batch.next_first_day)
        land_months(rows, landing, service.taxi_type)
        # strays of the month before in the next batch leave that month alone
        strays = in_month(pickup, batch) & (F.dayofmonth(pickup) == 28)
        land_rows(rows.where(in_month(pickup, following) | strays), landing, following)
    batch = RELOADED_MONTH
    month = (F.col("year") == batch.year) & (F.col("month") == batch.month)
    rows = scan_landed(spark, landing).where(month)
    return shown(rows.select("taxi_type", "VendorID", "PULocationID", "fare_amount"))


@query("scan_zone_csv")
def scan_zone_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone seed written and read as quoted CSV."""
    folder = scratch_folder(spark)
    zones = raw_zones(spark, sf_dir)
    zones.write.csv(folder, header=True, quoteAll=True, lineSep="\r\n")
    return scan_zones(spark, folder)


@query("upsert_table")
def upsert_stored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert carried out on a stored table partitioned by month."""
    name = scratch_lake(spark).raw("yellow")
    for batch in table_and_reload(spark, sf_dir):
        upsert_table(batch, name)
    return shown(spark.table(name).select(*RAW_SHOWN))


@query("upsert_bucketed")
def upsert_bucketed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert carried out on a table stored in buckets of the row key."""
    name = scratch_lake(spark).raw("yellow")
    for batch in table_and_reload(spark, sf_dir):
        upsert_bucketed(batch, name, Buckets(number=4))
    return shown(spark.table(name).select(*RAW_SHOWN))


@query("upsert_filtered")
def upsert_filtered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert with a key filter: all but the reloaded month are only appended to.

    The table arrives in two loads of alternate months, then one month is loaded again.
    """
    name = scratch_lake(spark).raw("yellow")
    trips, again = table_and_reload(spark, sf_dir)
    even = F.month(F.col(YELLOW.pickup)) % 2 == 0
    for batch in (trips.where(even), trips.where(~even), again):
        upsert_filtered(batch, name, KeyFilter(bits=1 << 20))
    return shown(spark.table(name).select(*RAW_SHOWN))


# The order of the copied fact: rows alike stand together, which shuffles and files pack tighter.
FACT_ORDER = (*FACT_PARTITIONS, "pickup_zone", "dropoff_zone")


@contextmanager
def fact_once(spark: SparkSession, sf_dir: str, lake: Lake) -> Iterator[DataFrame]:
    """The fact with its month, for queries whose steps read it more than once.

    It is computed once, staging and joins and all, and kept as a table of compressed
    columns while the steps read it. The shuffles of each step are removed when it ends.
    """
    name, trips = lake.table("fact_once"), with_pickup_month(fact(spark, sf_dir))
    order = [c for c in FACT_ORDER if c in trips.columns]
    with shuffles_removed(spark):
        rows = trips.sortWithinPartitions(*order).write.format("parquet")
        rows.option("compression", "zstd").saveAsTable(name)
        try:
            yield spark.table(name)
        finally:
            spark.sql(f"DROP TABLE {name}")


@query("incremental_load")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact loaded up to a date, then brought up to date by appending."""
    lake = scratch_lake(spark)
    name = lake.table("fact_trips")
    before = F.col("pickup_datetime") < F.lit(LOADED_BEFORE).cast("timestamp_ntz")
    with fact_once(spark, sf_dir, lake) as trips:
        refresh_table(trips.where(before), name, FACT_PARTITIONS)
        append_rows(newer_rows(trips, table_watermarks(spark, name)), name)
    return shown(spark.table(name).drop("pickup_month"))


@query("tipping_partials")
def tipping_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tipping rolled up from monthly states, after one month of the fact was corrected."""
    lake = scratch_lake(spark)
    name = lake.table("fact_trips")
    corrected = in_months(F.col(PICKUP_MONTH), [CORRECTED_MONTH])
    wrong = F.when(corrected, F.col("tip_amount") + 1).otherwise(F.col("tip_amount"))
    with fact_once(spark, sf_dir, lake) as trips:
        refresh_table(trips.withColumn("tip_amount", money(wrong)), name, FACT_PARTITIONS)
        refresh_tipping(spark, lake)
        replace_exactly(trips.where(corrected), name, corrected)
    refresh_tipping(spark, lake, months=[CORRECTED_MONTH])
    return shown(spark.table(lake.table("dm_tipping")), ("avg_tip_percentage",))


def one_file(rows: DataFrame) -> DataFrame:
    """The rows in one partition, to be written as one file.

    A shuffle into one writer: the joins that make the rows stay spread over tasks,
    where a coalesce would join and sort all of them in a single one.
    """
    return rows.repartition(1)


@query("stream_arrivals")
def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of even and odd years arrive, then a month again; at last all are delivered again.

    The month's file has a column the others lack. The ledger keeps files that are delivered
    twice from being taken twice, also by a query that has lost its checkpoint.
    """
    name, root = scratch_lake(spark).raw("yellow"), scratch_folder(spark)
    folder, trips = f"{root}/arrivals", raw_trips(spark, sf_dir, YELLOW)
    for odd in (0, 1):
        one_file(trips.where(F.year(YELLOW.pickup) % 2 == odd)).write.parquet(f"{folder}/first/{odd}")
    follow_arrivals(spark, folder, "yellow", name, f"{root}/checkpoint").awaitTermination()
    again = trips.where(in_month(F.col(YELLOW.pickup), RELOADED_MONTH)).withColumn("cbd_congestion_fee", F.lit(0.75))
    one_file(again.withColumn("fare_amount", money(F.col("fare_amount") + 10))).write.parquet(f"{folder}/second")
    for checkpoint in ("checkpoint", "new_checkpoint"):
        follow_arrivals(spark, folder, "yellow", name, f"{root}/{checkpoint}", 100).awaitTermination()
    load = F.when(F.col("source_file").contains("/second/"), "second load").otherwise("first load")
    return shown(spark.table(name).withColumn("source_file", load).select(*RAW_SHOWN))


@query("upsert_versioned")
def upsert_versioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert as two commits of a versioned table."""
    stored = VersionedTable(scratch_folder(spark))
    for batch in table_and_reload(spark, sf_dir):
        upsert_versioned(batch, stored)
    return shown(stored.read(spark).select(*RAW_SHOWN))


@query("published_snapshot")
def published_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart stored, published and read from the published version."""
    lake, root = scratch_lake(spark), scratch_folder(spark)
    name = lake.table("dm_monthly_zone")
    refresh_table(marts.monthly_zone_revenue(fact(spark, sf_dir)), name)
    publish_snapshot(spark, [name], root)
    return shown(read_snapshot(spark, root, "dm_monthly_zone"))


@query("published_months")
def published_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart by month published twice; the second version copies the corrected month only."""
    lake, root = scratch_lake(spark), scratch_folder(spark)
    name, trips = lake.table("dm_monthly_zone"), with_pickup_month(fact(spark, sf_dir))
    corrected = in_months(F.col(PICKUP_MONTH), [CORRECTED_MONTH])
    mart = marts.monthly_zone_revenue(trips)
    of_month = in_months(month_text(F.col("revenue_month")), [CORRECTED_MONTH])
    refresh_table(mart.withColumn("total_monthly_trips", F.when(of_month, 0).otherwise(F.col("total_monthly_trips"))), name, ("revenue_month",))
    publish_snapshot(spark, [name], root)
    replace_exactly(marts.monthly_zone_revenue(trips.where(corrected)), name, of_month)
    publish_snapshot(spark, [name], root)
    return shown(read_snapshot(spark, root, "dm_monthly_zone"))


# Data checks


@query("dq_unique")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query("dq_not_null")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly rows without a total, the totals of one service being blanked."""
    total = F.when(F.col("service_type") == "Yellow", F.col("revenue_monthly_total_amount"))
    monthly = marts.monthly_zone_revenue(fact(spark, sf_dir))
    failing = quality.nulls(
        monthly.withColumn("revenue_monthly_total_amount", total), "revenue_monthly_total_amount"
    )
    return failing.select("revenue_zone", "revenue_month", "service_type")


@query("dq_relationships")
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = known_zones(dim_zone(raw_zones(spark, sf_dir)))
    trips = staged(spark, sf_dir, YELLOW)
    failing = quality.orphans(trips, "pickup_locationid", known, "locationid")
    return failing.select("tripid", "pickup_locationid")


@query("dq_accepted_values")
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unaccepted(staged(spark, sf_dir, GREEN), "payment_type", [1, 2, 3])


def report_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "stg_yellow": staged(spark, sf_dir, YELLOW),
        "lineitem": table(spark, sf_dir, "lineitem"),
        "known_zones": known_zones(dim_zone(raw_zones(spark, sf_dir))),
        "dm_monthly_zone": marts.monthly_zone_revenue(fact(spark, sf_dir)),
    }


REPORTED = [
    *quality.staging_checks("stg_yellow", "known_zones"),
    quality.Check(quality.ACCEPTED_VALUES, "stg_yellow", ("count_passenger",), values=(1, 2, 3)),
    quality.Check(quality.UNIQUE, "lineitem", ("l_orderkey", "l_linenumber")),
    quality.revenue_check("dm_monthly_zone"),
]


@query("dq_report")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of check in one report; the zone and code lists are cut short."""
    return quality.run_checks(report_models(spark, sf_dir), REPORTED)


@query("dq_report_observed")
def dq_report_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, the checks of staging and mart gathered by the jobs that write them."""
    lake, models, reports = scratch_lake(spark), report_models(spark, sf_dir), []
    for model in ("stg_yellow", "dm_monthly_zone"):
        checks = WrittenChecks([c for c in REPORTED if c.model == model], models)
        name = lake.table(model)
        reports.append(checks.write(models[model], lambda rows: refresh_table(rows, name), lambda: spark.table(name)))
    rest = quality.run_checks(models, [c for c in REPORTED if c.model == "lineitem"])
    return reports[0].unionByName(rest).unionByName(reports[1])
