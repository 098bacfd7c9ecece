from __future__ import annotations

from datetime import date

import pytest
from conftest import at
from rows import green, raw, yellow, zones

from trip_marts.operators.quality import ChecksFailed
from trip_marts.operators.upsert import upsert_table
from trip_marts.plans import pipeline
from trip_marts.plans.pipeline import MARTS, BuildOptions, Lake, backfill, build, ingest_month
from trip_marts.schemas import GREEN, YELLOW
from trip_marts.sources.files import MonthBatch, month_range
from trip_marts.sources.snapshots import latest_version, publish_snapshot, read_snapshot
from trip_marts.sources.tables import list_tables, refresh_table
from trip_marts.streaming.ingest import ingest_arrivals

JANUARY = {"pickup": at("2023-01-10 08:00:00"), "dropoff": at("2023-01-10 08:20:00")}
FEBRUARY = {"pickup": at("2023-02-10 08:00:00"), "dropoff": at("2023-02-10 08:20:00")}


@pytest.fixture
def roots(tmp_path):
    return f"{tmp_path}/source", f"{tmp_path}/landing"


def deliver(spark, roots, service, year, month, *changes):
    batch = MonthBatch(service.taxi_type, year, month)
    path = f"{roots[0]}/{batch.source_key}"
    raw(spark, service, *changes).coalesce(1).write.mode("overwrite").parquet(path)
    return batch


def deliver_two_months(spark, roots):
    for service in (YELLOW, GREEN):
        deliver(spark, roots, service, 2023, 1, JANUARY, {**JANUARY, "VendorID": 2})
        deliver(spark, roots, service, 2023, 2, FEBRUARY)


def ingest_two_months(spark, lake, roots):
    deliver_two_months(spark, roots)
    for service in (YELLOW, GREEN):
        months = month_range(service.taxi_type, date(2023, 1, 1), date(2023, 2, 28))
        backfill(spark, lake, *roots, months)


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def fact_rows(spark, lake):
    columns = ["service_type", "vendorid", "pickup_month", "fare_amount"]
    return contents(spark.table(lake.table("fact_trips")).select(*columns))


def test_backfill_twice_gives_the_same_tables(spark, lake, roots):
    ingest_two_months(spark, lake, roots)
    once = contents(spark.table(lake.raw("yellow")))
    ingest_two_months(spark, lake, roots)
    assert contents(spark.table(lake.raw("yellow"))) == once
    months = spark.table(lake.raw("green")).groupBy("pickup_month").count()
    assert contents(months) == [("2023-01", 2), ("2023-02", 1)]
    sources = [r.source_file for r in spark.table(lake.raw("green")).collect()]
    assert all("taxi_type=green/year=2023/month=" in s for s in sources)


def test_build_from_raw_tables_to_published_marts(spark, lake, roots, tmp_path):
    ingest_two_months(spark, lake, roots)
    root = f"{tmp_path}/published"
    warnings = build(spark, lake, zones(spark), publish_root=root)
    assert warnings == []
    assert set(MARTS) | {"dim_zone", "fact_trips"} <= set(list_tables(spark, lake.database))
    trips = read_snapshot(spark, root, "dm_monthly_zone").selectExpr("sum(total_monthly_trips)")
    assert trips.first()[0] == spark.table(lake.table("fact_trips")).count() == 6
    ranks = spark.table(lake.table("dm_origin_destination")).where("route_popularity_rank = 1")
    assert ranks.select("service_type", "report_month").distinct().count() == 4


def test_second_build_appends_only_new_trips(spark, lake, roots):
    ingest_two_months(spark, lake, roots)
    build(spark, lake, zones(spark))
    before = fact_rows(spark, lake)
    files = set(spark.table(lake.table("fact_trips")).inputFiles())
    build(spark, lake, zones(spark))
    assert fact_rows(spark, lake) == before
    march = {"pickup": at("2023-03-01 00:00:00"), "fare_amount": 7.0}
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 3, march))
    build(spark, lake, zones(spark))
    added = set(fact_rows(spark, lake)) - set(before)
    assert {row[:3] for row in added} == {("Yellow", 1, "2023-03")}
    assert files <= set(spark.table(lake.table("fact_trips")).inputFiles())


def test_service_loaded_late_in_the_month_is_not_lost(spark, lake, roots):
    deliver_two_months(spark, roots)
    ingest_month(spark, lake, *roots, MonthBatch("yellow", 2023, 1))
    ingest_month(spark, lake, *roots, MonthBatch("yellow", 2023, 2))
    deliver(spark, roots, GREEN, 2023, 1)
    ingest_month(spark, lake, *roots, MonthBatch("green", 2023, 1))
    build(spark, lake, zones(spark))
    ingest_month(spark, lake, *roots, deliver(spark, roots, GREEN, 2023, 1, JANUARY))
    # One mark over both services skips the green trip, a mark of its own does not.
    build(spark, lake, zones(spark), BuildOptions(global_mark=True))
    assert [row for row in fact_rows(spark, lake) if row[0] == "Green"] == []
    build(spark, lake, zones(spark))
    assert [row[:3] for row in fact_rows(spark, lake) if row[0] == "Green"] == [
        ("Green", 1, "2023-01")
    ]


def test_marts_of_unchanged_months_are_not_rewritten(spark, lake, roots):
    ingest_two_months(spark, lake, roots)
    build(spark, lake, zones(spark))
    files = {n: set(spark.table(lake.table(n)).inputFiles()) for n in pipeline.MART_MONTHS}
    build(spark, lake, zones(spark))
    assert {n: set(spark.table(lake.table(n)).inputFiles()) for n in files} == files
    march = {"pickup": at("2023-03-01 00:00:00"), "dropoff": at("2023-03-01 00:10:00")}
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 3, march))
    build(spark, lake, zones(spark))
    fact = spark.table(lake.table("fact_trips"))
    for name, mart in MARTS.items():
        table = spark.table(lake.table(name))
        assert files.get(name, set()) <= set(table.inputFiles())
        expected = mart(fact)
        assert contents(table.select(*expected.columns)) == contents(expected)


def test_marts_catch_up_after_a_run_that_stopped(spark, lake, roots, monkeypatch):
    ingest_two_months(spark, lake, roots)
    build(spark, lake, zones(spark))
    march = {"pickup": at("2023-03-01 00:00:00")}
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 3, march))

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(pipeline, "refresh_marts", stopped)
        with pytest.raises(RuntimeError):
            build(spark, lake, zones(spark))
    assert pipeline.pending_months(spark, lake) == ["2023-03"]
    build(spark, lake, zones(spark))
    assert pipeline.pending_months(spark, lake) == []
    monthly = spark.table(lake.table("dm_monthly_zone"))
    assert monthly.where("revenue_month = timestamp_ntz'2023-03-01'").count() == 1


def test_late_trips_are_upserted_by_month(spark, lake, roots):
    ingest_two_months(spark, lake, roots)
    build(spark, lake, zones(spark))
    changes = [{**JANUARY, "fare_amount": 50.0}, {**JANUARY, "VendorID": 3}]
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 1, *changes))
    build(spark, lake, zones(spark), BuildOptions(by_mark=True))
    assert len(fact_rows(spark, lake)) == 6
    build(spark, lake, zones(spark))
    january = [r for r in fact_rows(spark, lake) if r[0] == "Yellow" and r[2] == "2023-01"]
    # the raw month no longer holds vendor 2, and neither does the fact
    assert [(v, float(fare)) for _, v, _, fare in january] == [(1, 50.0), (3, 20.0)]
    assert len(fact_rows(spark, lake)) == 6


def test_future_late_and_null_pickups_are_loaded(spark, lake, roots):
    ingest_two_months(spark, lake, roots)
    build(spark, lake, zones(spark))
    future, nobody = {"pickup": at("2098-01-01 00:00:00")}, {"pickup": None}
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 3, future, nobody))
    build(spark, lake, zones(spark))
    march = {"pickup": at("2023-03-01 00:00:00")}
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 4, march))
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 1, {**JANUARY, "VendorID": 4}))
    build(spark, lake, zones(spark))
    stepwise = fact_rows(spark, lake)
    build(spark, lake, zones(spark), BuildOptions(full_refresh=True))
    assert fact_rows(spark, lake) == stepwise
    assert {row[2] for row in stepwise} >= {"2098-01", "2023-03"} and len(stepwise) >= 8


def test_failed_refresh_keeps_the_old_table(spark, lake):
    for name, parts in ((lake.table("plain"), ()), (lake.table("parted"), ("p",))):
        refresh_table(spark.createDataFrame([("a", 1)], "p string, v int"), name, parts)
        broken = spark.createDataFrame([("b", 2)], "p string, v int").selectExpr("p", "cast(raise_error('stop') as int) as v")
        with pytest.raises(Exception, match="stop"):
            refresh_table(broken, name, parts)
        assert [tuple(r) for r in spark.table(name).select("p", "v").collect()] == [("a", 1)]


def test_later_types_widen_or_are_refused(spark, lake):
    name = lake.table("t")
    schema = "row_key string, x {}, pickup_month string"
    upsert_table(spark.createDataFrame([("a", 1, "m")], schema.format("int")), name, keys=("row_key",))
    upsert_table(spark.createDataFrame([("b", 2.75, "m")], schema.format("double")), name, keys=("row_key",))
    assert sorted(r.x for r in spark.table(name).collect()) == [1.0, 2.75]
    with pytest.raises(ValueError, match="'x'"):
        upsert_table(spark.createDataFrame([("c", "z", "m")], schema.format("string")), name, keys=("row_key",))


def test_newest_snapshot_is_the_last_published(spark, lake, tmp_path):
    name, root = lake.table("t"), f"{tmp_path}/snap"
    for number, version in enumerate(("v9", "v10")):
        refresh_table(spark.createDataFrame([(number,)], "n int"), name)
        publish_snapshot(spark, [name], root, version)
    assert read_snapshot(spark, root, "t").first().n == 1


def test_month_that_leaves_a_mart_is_removed_from_it(spark, lake, roots):
    for service in (YELLOW, GREEN):
        deliver(spark, roots, service, 2023, 1, JANUARY)
        ingest_month(spark, lake, *roots, MonthBatch(service.taxi_type, 2023, 1))
    february = deliver(spark, roots, YELLOW, 2023, 2, FEBRUARY)
    ingest_month(spark, lake, *roots, february)
    build(spark, lake, zones(spark))
    # The same trip again, now ending as it starts, which the hourly mart skips.
    still = {**FEBRUARY, "dropoff": FEBRUARY["pickup"], "total_amount": 1.0}
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 2, still))
    upserted = spark.table(lake.raw("yellow"))
    assert upserted.count() == 3  # another drop-off time is another raw row
    build(spark, lake, zones(spark), BuildOptions(reload_months=("2023-02",)))
    fact = spark.table(lake.table("fact_trips"))
    for name, mart in MARTS.items():
        expected = mart(fact)
        stored = spark.table(lake.table(name)).select(*expected.columns)
        assert contents(stored) == contents(expected)
    hourly = spark.table(lake.table("dm_hourly_operation"))
    assert [r[0] for r in hourly.select("report_month").distinct().collect()] == [at("2023-01-01")]


def test_full_refresh_and_compatibility_options(spark, lake, roots):
    ingest_two_months(spark, lake, roots)
    build(spark, lake, zones(spark))
    fact = spark.table(lake.table("fact_trips"))
    assert float(fact.where("service_type = 'Green'").first().total_amount) == 25.8
    build(spark, lake, zones(spark), BuildOptions(full_refresh=True, by_position=True))
    fact = spark.table(lake.table("fact_trips"))
    assert float(fact.where("service_type = 'Green'").first().total_amount) == 0.3
    build(spark, lake, zones(spark), BuildOptions(full_refresh=True, sample_rows=1))
    assert spark.table(lake.table("fact_trips")).count() == 2


def test_warnings_of_a_build(spark, lake, roots):
    ingest_two_months(spark, lake, roots)
    bad = {**JANUARY, "VendorID": 4, "PULocationID": 77, "payment_type": None}
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 1, bad))
    warnings = build(spark, lake, zones(spark))
    assert {(w.check_name, w.failures) for w in warnings} == {
        ("relationships_stg_yellow_pickup_locationid", 1),
        ("accepted_values_stg_yellow_payment_type", 1),
    }
    options = BuildOptions(check_months=("2023-02",))
    assert build(spark, lake, zones(spark), options) == []


def test_error_check_prevents_publishing(spark, lake, roots, tmp_path):
    deliver_two_months(spark, roots)
    nothing_paid = {**JANUARY, "total_amount": None}
    deliver(spark, roots, YELLOW, 2023, 1, nothing_paid)
    for taxi_type in ("yellow", "green"):
        ingest_month(spark, lake, *roots, MonthBatch(taxi_type, 2023, 1))
    root = f"{tmp_path}/published"
    with pytest.raises(ChecksFailed, match="revenue_monthly_total_amount: 1"):
        build(spark, lake, zones(spark), publish_root=root)
    assert latest_version(spark, root) is None


def test_default_lake_names():
    assert Lake().raw("yellow") == "default.trips_yellow"
    assert len(pipeline.declared_checks(Lake())) == 12


def test_arrivals_are_taken_once_and_give_the_backfill_result(spark, lake, roots, tmp_path):
    ingest_two_months(spark, lake, roots)
    folder = f"{roots[0]}/yellow"
    schema = yellow(spark, {}).schema

    def arrivals():
        query = ingest_arrivals(
            spark, folder, "yellow", schema, lake.table("streamed"), f"{tmp_path}/checkpoint"
        )
        query.awaitTermination()
        return sum(progress.numInputRows for progress in query.recentProgress)

    assert arrivals() > 0
    without_source = [c for c in spark.table(lake.table("streamed")).columns if c != "source_file"]
    streamed = spark.table(lake.table("streamed")).select(*without_source)
    assert contents(streamed) == contents(spark.table(lake.raw("yellow")).select(*without_source))
    assert arrivals() == 0
    deliver(spark, roots, YELLOW, 2023, 3, {"pickup": at("2023-03-01 00:00:00")})
    arrivals()
    assert spark.table(lake.table("streamed")).count() == 4


def test_green_fixture_has_its_own_names(spark):
    assert GREEN.pickup in green(spark, {}).columns
