from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import at
from rows import green, yellow, zones

from trip_marts.plans import marts, serving
from trip_marts.plans.dimension import dim_zone, known_zones
from trip_marts.plans.fact import fact_trips
from trip_marts.plans.staging import stage_trips
from trip_marts.schemas import CREDIT_CARD_AS_WRITTEN, FACT_COLUMNS, GREEN, YELLOW

START = at("2023-01-01 10:00:00")


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def fact_of(spark, yellow_rows=(), green_rows=(), by_position=False):
    return fact_trips(
        stage_trips(yellow(spark, *yellow_rows), YELLOW),
        stage_trips(green(spark, *green_rows), GREEN),
        dim_zone(zones(spark)),
        by_position,
    )


def many(count, **values):
    """Trips that differ in pickup time only."""
    return [
        {
            "pickup": START + timedelta(hours=i),
            "dropoff": START + timedelta(hours=i, minutes=30),
            **values,
        }
        for i in range(count)
    ]


def test_staging_columns_and_types(spark):
    staged = stage_trips(yellow(spark, {}), YELLOW)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in staged.schema.fields] == [
        "tripid string",
        "vendorid int",
        "count_passenger int",
        "ratecodeid int",
        "pickup_locationid int",
        "dropoff_locationid int",
        "pickup_datetime timestamp_ntz",
        "dropoff_datetime timestamp_ntz",
        "trip_distance decimal(18,3)",
        "trip_type int",
        "store_and_fwd_flag string",
        "payment_type int",
        "payment_type_describe string",
        "fare_amount decimal(18,3)",
        "extra decimal(18,3)",
        "mta_tax decimal(18,3)",
        "tip_amount decimal(18,3)",
        "tolls_amount decimal(18,3)",
        "improvement_surcharge decimal(18,3)",
        "total_amount decimal(18,3)",
        "congestion_surcharge decimal(18,3)",
        "airport_fee decimal(18,3)",
    ]


def test_staging_drops_null_vendors_and_repeated_keys(spark):
    later = {"dropoff": at("2023-01-01 11:00:00"), "fare_amount": 99.0}
    staged = stage_trips(
        yellow(
            spark, {"VendorID": None}, later, {}, {"VendorID": 2}, {"pickup": None}, {"pickup": None}
        ),
        YELLOW,
    )
    assert contents(staged.select("vendorid", "pickup_datetime", "fare_amount")) == [
        (1, None, Decimal("20.000")),
        (1, START, Decimal("20.000")),
        (2, START, Decimal("20.000")),
    ]


def test_green_trips_have_their_own_columns(spark):
    row = stage_trips(green(spark, {"ehail_fee": None, "trip_type": 2}), GREEN).first()
    assert (row.ehail_fee, row.trip_type) == (0, 2)
    assert stage_trips(green(spark, {"trip_type": None}), GREEN).first().trip_type is None


def test_null_payment_has_code_zero_and_its_own_label(spark):
    payments = [{"payment_type": p, "VendorID": i} for i, p in enumerate((None, 1, 9))]
    staged = stage_trips(yellow(spark, *payments), YELLOW)
    assert contents(staged.select("vendorid", "payment_type", "payment_type_describe")) == [
        (0, 0, "EMPTY"),
        (1, 1, "Credit card"),
        (2, 9, "EMPTY"),
    ]


def test_staging_accepts_other_letter_case_and_rejects_missing_columns(spark):
    df = yellow(spark, {})
    assert stage_trips(df.withColumnRenamed("airport_fee", "Airport_fee"), YELLOW).count() == 1
    with pytest.raises(ValueError, match="fare_amount"):
        stage_trips(df.drop("fare_amount"), YELLOW)


def test_staging_sample(spark):
    assert stage_trips(yellow(spark, *many(30)), YELLOW, sample_rows=10).count() == 10


def test_zone_names_and_known_boroughs(spark):
    dim = dim_zone(zones(spark))
    assert dim.where("locationid = 2").first().service_zone == "Green Zone"
    assert contents(known_zones(dim).select("locationid")) == [(1,), (2,), (3,), (4,), (8,)]


def test_fact_keeps_only_trips_between_known_zones(spark):
    pairs = [(1, 2), (7, 2), (1, 7), (8, 1), (9, 1), (1, 77), (None, 1)]
    rows = [
        {"VendorID": i, "PULocationID": p, "DOLocationID": d} for i, (p, d) in enumerate(pairs)
    ]
    fact = fact_of(spark, rows)
    assert fact.columns == FACT_COLUMNS
    assert contents(fact.select("vendorid", "pickup_zone", "dropoff_borough")) == [
        (0, "Airport Road", "Bronx"),
        (3, "Outside", "Queens"),
    ]


def test_green_amounts_survive_the_union(spark):
    row = {
        "ehail_fee": 1.0,
        "improvement_surcharge": 2.0,
        "total_amount": 30.0,
        "congestion_surcharge": 4.0,
    }
    names = ["improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee"]
    by_name = fact_of(spark, green_rows=[row]).select(*names).first()
    assert tuple(by_name) == (2, 30, 4, None)
    by_position = fact_of(spark, green_rows=[row], by_position=True).select(*names).first()
    assert tuple(by_position) == (1, 2, 30, 4)


def test_services_may_share_a_trip_id(spark):
    fact = fact_of(spark, [{}], [{}])
    assert fact.count() == 2
    assert fact.select("tripid").distinct().count() == 1


def test_monthly_zone_revenue(spark):
    february = at("2023-02-05 00:00:00")
    rows = [
        {"passenger_count": 1.0, "airport_fee": 1.0},
        {"VendorID": 2, "passenger_count": 2.0, "trip_distance": 2.0, "airport_fee": None},
        {"pickup": february},
    ]
    monthly = marts.monthly_zone_revenue(fact_of(spark, rows, [{}]))
    chosen = monthly.where("revenue_month = timestamp_ntz'2023-01-01' AND service_type = 'Yellow'")
    row = chosen.first()
    assert row.revenue_monthly_total_amount == Decimal("51.600")
    assert row.revenue_monthly_airport_fee == 1
    assert (row.total_monthly_trips, row.avg_monthly_count_passenger) == (2, 1.5)
    assert row.avg_monthly_trip_distance == 3.5
    green_row = monthly.where("service_type = 'Green'").first()
    assert green_row.revenue_monthly_airport_fee is None
    assert monthly.count() == 3


def test_repeated_zone_names_share_a_row(spark):
    rows = [{"VendorID": 1, "PULocationID": 3}, {"VendorID": 2, "PULocationID": 4}]
    monthly = marts.monthly_zone_revenue(fact_of(spark, rows))
    assert contents(monthly.select("revenue_zone", "total_monthly_trips")) == [("Old Town", 2)]


def test_hourly_operation(spark):
    rows = [
        {},
        {"VendorID": 2, "dropoff": at("2023-01-01 10:00:05")},
        {"VendorID": 3, "trip_distance": 0.0},
        {"VendorID": 4, "trip_distance": -1.0},
        {"VendorID": 5, "dropoff": START},
        {"VendorID": 6, "dropoff": None},
    ]
    hourly = marts.hourly_operation(fact_of(spark, rows))
    # 30 minutes for 5 miles and 25.8 in total; the 5 second trip has no speed.
    assert contents(hourly) == [
        ("Yellow", at("2023-01-01"), 0, 10, 2, 15.0, 5.0, 10.0, 25.8 / 30)
    ]


def test_hourly_display_order_puts_nulls_last(spark):
    df = spark.createDataFrame(
        [("Yellow", None, 0, 1), ("Green", 1, 6, 0), ("Yellow", 2, 0, 0), (None, 0, 0, 0)],
        "service_type string, report_month int, day_of_week int, hour_of_day int",
    )
    ordered = marts.in_display_order(df).select("service_type", "report_month").collect()
    assert [tuple(r) for r in ordered] == [
        ("Green", 1),
        ("Yellow", 2),
        ("Yellow", None),
        (None, 0),
    ]


def test_routes_rank_and_ratio(spark):
    rows = many(2, trip_distance=0.0) + many(2, VendorID=2, DOLocationID=3)
    rows += many(1, VendorID=3, PULocationID=2)
    routes = marts.od_routes(fact_of(spark, rows))
    shown = routes.select(
        "pickup_zone", "dropoff_zone", "trip_count", "route_popularity_rank", "revenue_per_mile"
    )
    assert contents(shown) == [
        ("Airport Road", "Hill Side", 2, 1, None),
        ("Airport Road", "Old Town", 2, 1, 5.16),
        ("Hill Side", "Hill Side", 1, 3, 5.16),
    ]


def test_tipping_drops_small_groups_and_unpaid_trips(spark):
    rows = many(11) + many(10, VendorID=2, PULocationID=2)
    rows += many(20, VendorID=3, PULocationID=3, total_amount=0.0)
    tips = marts.tipping(fact_of(spark, rows))
    assert contents(tips.drop("service_type")) == [
        ("Airport Road", "Credit card", 11, 11, 100.0, 4.0, 20.0)
    ]


def test_tip_percentage_counts_card_trips_with_a_fare(spark):
    rows = many(10) + many(5, VendorID=2, fare_amount=0.0, tip_amount=0.0)
    tips = marts.tipping(fact_of(spark, rows)).first()
    assert (tips.total_trips, tips.count_trips_with_tip, tips.avg_tip_percentage) == (15, 10, 20.0)
    assert tips.percentage_trips_with_tip == 1000 / 15
    other = marts.tipping(fact_of(spark, rows), credit_label=CREDIT_CARD_AS_WRITTEN).first()
    assert other.avg_tip_percentage is None
    cash = marts.tipping(fact_of(spark, many(11, payment_type=2))).first()
    assert cash.avg_tip_percentage is None


MONTHLY = (
    "revenue_zone string, revenue_month int, service_type string, "
    "revenue_monthly_total_amount decimal(38,3), total_monthly_trips bigint, "
    "avg_monthly_trip_distance double"
)


def monthly_example(spark):
    rows = [
        ("A", 1, "Yellow", Decimal(10), 1, 1.0),
        ("B", 1, "Yellow", Decimal(20), 3, 3.0),
        ("B", 2, "Green", None, 0, None),
        (None, None, "Green", Decimal(5), 1, 2.0),
    ]
    return spark.createDataFrame(rows, MONTHLY)


def test_kpis_use_the_plain_mean_of_means(spark):
    monthly = monthly_example(spark)
    assert tuple(serving.kpi_totals(monthly).first()) == (35, 5, 2.0)
    assert serving.weighted_distance(monthly).first()[0] == 12 / 5


def test_charts_leave_out_null_groups(spark):
    monthly = monthly_example(spark)
    assert contents(serving.revenue_trend(monthly)) == [(1, "Yellow", 30), (2, "Green", None)]
    top = [tuple(r) for r in serving.top_zones(monthly).collect()]
    assert top == [("B", 20), ("A", 10)]
    assert len(serving.top_zones(monthly, rows=1).collect()) == 1


def test_hourly_charts(spark):
    hourly = spark.createDataFrame(
        [
            ("Yellow", 0, 5, 2, 10.0),
            ("Yellow", 0, 5, 3, None),
            ("Yellow", 1, 5, 4, 30.0),
            ("Green", 0, 5, 9, 99.0),
            ("Yellow", None, None, 7, 1.0),
        ],
        "service_type string, day_of_week int, hour_of_day int, total_trips bigint, "
        "avg_speed_mph double",
    )
    assert contents(serving.service_choices(hourly)) == [("Green",), ("Yellow",)]
    heatmap = serving.weekday_hour_heatmap(hourly, "Yellow")
    assert contents(heatmap) == [(0, 5, 5), (1, 5, 4)]
    assert contents(serving.speed_by_hour(hourly, "Yellow")) == [(5, 20.0)]
    by_trips = contents(serving.speed_by_hour(hourly, "Yellow", weighted=True))
    assert by_trips == [(5, 140 / 6)]  # the row without a speed has no weight


def test_route_and_tip_charts(spark):
    routes = spark.createDataFrame(
        [("A", "B", 5, 1.0), ("A", "B", 1, 3.0), ("A", "A", 6, 4.0), ("C", "C", 1, 9.0)],
        "pickup_zone string, dropoff_zone string, trip_count bigint, avg_cost_per_trip double",
    )
    top = [tuple(r) for r in serving.top_routes(routes, rows=2).collect()]
    assert top == [("A", "A", 6, 4.0), ("A", "B", 6, 2.0)]
    by_trips = [tuple(r) for r in serving.top_routes(routes, rows=2, weighted=True).collect()]
    assert by_trips == [("A", "A", 6, 4.0), ("A", "B", 6, 8 / 6)]
    tips = spark.createDataFrame(
        [("Cash", None, 20), ("Credit card", 10.0, 15), ("Credit card", 20.0, 15), (None, 1.0, 9)],
        "payment_type_describe string, avg_tip_percentage double, total_trips bigint",
    )
    by_payment = [tuple(r) for r in serving.tip_by_payment(tips).collect()]
    assert by_payment == [("Credit card", 15.0, 30), ("Cash", None, 20)]
    more = tips.union(spark.createDataFrame([("Credit card", 30.0, 30)], tips.schema))
    by_trips = [tuple(r) for r in serving.tip_by_payment(more, weighted=True).collect()]
    assert by_trips == [("Credit card", 22.5, 60), ("Cash", None, 20)]
