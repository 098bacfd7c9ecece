from __future__ import annotations

import random

import pytest
from conftest import at
from pyspark.sql import functions as F

from trip_marts.operators import quality
from trip_marts.operators.dedup import first_per_key
from trip_marts.operators.incremental import (
    global_watermark,
    newer_rows,
    table_watermarks,
    watermarks,
)
from trip_marts.operators.quality import Check, ChecksFailed, enforce, run_checks
from trip_marts.operators.ranking import rank_by_count
from trip_marts.operators.sampling import sample_limit
from trip_marts.operators.unions import union_services, with_service
from trip_marts.operators.upsert import matched_rows, upsert_rows, upsert_table
from trip_marts.sources.tables import refresh_table

RAW = "unique_row_id string, v int, pickup_month string"


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_per_key_against_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (rng.choice([1, 2, None]), rng.randrange(4), rng.choice([None, *range(5)]), i)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "a int, b int, o int, id int").repartition(5)
    expected = {}
    for row in rows:
        order = (row[2] is None, row[2] or 0, row[3])
        if row[:2] not in expected or order < expected[row[:2]][0]:
            expected[row[:2]] = (order, row)
    got = first_per_key(df, ["a", "b"], ["o", "id"])
    assert contents(got) == sorted((r for _, r in expected.values()), key=str)


def test_union_by_name_and_by_position(spark):
    first = spark.createDataFrame([(1, 2, 3)], "total int, congestion int, airport int")
    second = spark.createDataFrame([(4, 5, 6)], "ehail int, total int, congestion int")
    first, second = with_service(first, "Yellow"), with_service(second, "Green")
    by_name = union_services(first, second).select("total", "congestion", "airport", "ehail")
    assert contents(by_name) == [(1, 2, 3, None), (5, 6, None, 4)]
    by_position = union_services(first, second, by_position=True)
    assert contents(by_position) == [(1, 2, 3, "Yellow"), (4, 5, 6, "Green")]


def test_sample_limit(spark):
    df = spark.range(250)
    assert sample_limit(df, 100).count() == 100
    assert sample_limit(df, None).count() == 250


def test_rank_shares_places(spark):
    df = spark.createDataFrame([("a", 2), ("a", 2), ("a", 1), ("b", 1)], "g string, n int")
    ranked = df.withColumn("r", rank_by_count(["g"], "n"))
    assert contents(ranked) == [("a", 1, 3), ("a", 2, 1), ("a", 2, 1), ("b", 1, 1)]


def upsert_example(spark):
    target = spark.createDataFrame(
        [("k1", 1, "2023-01"), ("k1", 2, "2023-01"), ("k2", 3, "2023-01"), ("k3", 4, None)], RAW
    )
    batch = spark.createDataFrame(
        [("k1", 10, "2023-01"), ("k4", 20, "2023-02"), ("k4", 21, "2023-02"), ("k3", 30, None)],
        RAW,
    )
    after = [
        ("k1", 10, "2023-01"),
        ("k2", 3, "2023-01"),
        ("k3", 30, None),
        ("k4", 20, "2023-02"),
        ("k4", 21, "2023-02"),
    ]
    return target, batch, after


def test_upsert_rows_keeps_duplicates_inside_the_batch(spark):
    target, batch, after = upsert_example(spark)
    assert contents(upsert_rows(target, batch)) == after
    assert contents(matched_rows(target, batch, ["unique_row_id"]).select("v")) == [
        (1,),
        (2,),
        (4,),
    ]


def test_upsert_table_twice_is_upsert_once(spark, lake):
    target, batch, after = upsert_example(spark)
    name = lake.table("t")
    for rows in (target, batch, batch):
        upsert_table(rows, name)
    assert contents(spark.table(name)) == after


def test_upsert_table_leaves_other_months_untouched(spark, lake):
    name = lake.table("t")
    rows = [("k1", 1, "2023-01"), ("k2", 2, "2023-02")]
    upsert_table(spark.createDataFrame(rows, RAW), name)
    files = {f for f in spark.table(name).inputFiles() if "2023-01" in f}
    upsert_table(spark.createDataFrame([("k2", 3, "2023-02")], RAW), name)
    assert files <= set(spark.table(name).inputFiles())
    assert contents(spark.table(name)) == [("k1", 1, "2023-01"), ("k2", 3, "2023-02")]


def test_upsert_of_a_batch_with_fewer_more_and_reordered_columns(spark, lake):
    name = lake.table("t")
    upsert_table(spark.createDataFrame([("k1", 1, "2023-01")], RAW), name)
    wider = spark.createDataFrame(
        [("2023-01", 0.5, "k2")], "pickup_month string, w double, unique_row_id string"
    )
    upsert_table(wider, name)
    assert contents(spark.table(name).select("unique_row_id", "v", "w")) == [
        ("k1", 1, None),
        ("k2", None, 0.5),
    ]


def test_upsert_against_brute_force(spark, lake):
    rng = random.Random(3)
    name, expected = lake.table("t"), []
    for _ in range(3):
        # The month follows from the key, as it does for trips.
        keys = [rng.randrange(40) for _ in range(30)]
        batch = [(f"k{k}", rng.randrange(1000), f"2023-{k % 5 + 1:02d}") for k in keys]
        upsert_table(spark.createDataFrame(batch, RAW).repartition(3), name)
        replaced = {key for key, _, _ in batch}
        expected = [row for row in expected if row[0] not in replaced] + batch
        assert contents(spark.table(name)) == sorted(expected, key=str)


TRIPS = "service_type string, pickup_datetime timestamp_ntz, pickup_month string, id int"


def trip(service, text, number):
    return (service, at(text), text[:7], number)


def test_watermark_is_kept_per_service(spark):
    loaded = spark.createDataFrame(
        [trip("Yellow", "2023-02-10 00:00:00", 1), trip("Green", "2023-01-05 00:00:00", 2)], TRIPS
    )
    incoming = spark.createDataFrame(
        [
            trip("Yellow", "2023-02-10 00:00:00", 3),
            trip("Yellow", "2023-02-10 00:00:01", 4),
            trip("Green", "2023-01-20 00:00:00", 5),
            trip("Purple", "2020-01-01 00:00:00", 6),
            ("Green", None, None, 7),
        ],
        TRIPS,
    )
    marks = watermarks(loaded)
    assert contents(newer_rows(incoming, marks).select("id")) == [(4,), (5,), (6,)]
    assert global_watermark(marks) == at("2023-02-10 00:00:00")


def test_empty_target_takes_everything(spark):
    empty = spark.createDataFrame([], TRIPS)
    incoming = spark.createDataFrame([trip("Green", "2023-01-05 00:00:00", 1)], TRIPS)
    assert watermarks(empty) == {}
    assert global_watermark({}) is None
    assert newer_rows(incoming, {}).count() == 1


def test_table_watermarks_use_the_last_month_of_each_service(spark, lake):
    rows = [
        trip("Yellow", "2023-02-10 00:00:00", 1),
        trip("Yellow", "2023-01-31 00:00:00", 2),
        trip("Green", "2023-01-05 00:00:00", 3),
        ("Green", None, None, 4),
    ]
    df = spark.createDataFrame(rows, TRIPS)
    name = lake.table("t")
    refresh_table(df.limit(0), name, ["service_type", "pickup_month"])
    assert table_watermarks(spark, name) == {}
    refresh_table(df, name, ["service_type", "pickup_month"])
    assert table_watermarks(spark, name) == watermarks(df)


MODEL = "id int, a int, code int, place int"


def checked_models(spark):
    child = spark.createDataFrame(
        [
            (1, 1, 0, 5),
            (1, None, 1, 5),
            (2, 3, 9, 99),
            (None, 4, 9, 99),
            (None, None, None, None),
        ],
        MODEL,
    )
    parent = spark.createDataFrame([(5,), (5,), (6,), (None,)], "place int")
    return {"child": child, "parent": parent}


CHECKS = [
    Check(quality.UNIQUE, "child", ("id",)),
    Check(quality.NOT_NULL, "child", ("a",)),
    Check(quality.RELATIONSHIPS, "child", ("place",), parent="parent", parent_column="place"),
    Check(quality.ACCEPTED_VALUES, "child", ("code",), values=(1, 2)),
    Check(quality.UNIQUE, "child", ("id", "a")),
]


def test_report_counts_like_the_failing_rows(spark):
    models = checked_models(spark)
    child, parent = models["child"], models["parent"]
    counts = {r.check_name: r.failures for r in run_checks(models, CHECKS).collect()}
    assert counts == {
        "unique_child_id": 1,
        "not_null_child_a": 2,
        "relationships_child_place": 2,
        "accepted_values_child_code": 2,
        "unique_child_id_a": 0,
    }
    assert contents(quality.duplicates(child, "id")) == [(1, 2)]
    assert quality.nulls(child, "a").count() == 2
    assert quality.orphans(child, "place", parent, "place").count() == 2
    assert contents(quality.unaccepted(child, "code", [1, 2])) == [(0, 1), (9, 2)]


def test_report_of_an_empty_model_has_no_failures(spark):
    models = checked_models(spark)
    models["child"] = models["child"].limit(0)
    assert [r.failures for r in run_checks(models, CHECKS).collect()] == [0] * 5


def test_warnings_are_returned_and_errors_raise(spark):
    report = run_checks(checked_models(spark), CHECKS)
    assert len(enforce(report)) == 4
    strict = [Check(quality.NOT_NULL, "child", ("a",), severity=quality.ERROR)]
    with pytest.raises(ChecksFailed, match="not_null_child_a: 2"):
        enforce(run_checks(checked_models(spark), strict))


def test_null_revenue_total_stops_the_run(spark):
    monthly = spark.createDataFrame([(None,)], "revenue_monthly_total_amount decimal(38,3)")
    report = run_checks({"m": monthly}, [quality.revenue_check("m")])
    with pytest.raises(ChecksFailed):
        enforce(report)
    filled = monthly.withColumn("revenue_monthly_total_amount", F.lit(1))
    assert enforce(run_checks({"m": filled}, [quality.revenue_check("m")])) == []
