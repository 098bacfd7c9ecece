from __future__ import annotations

import hashlib
import random
from decimal import Decimal

import duckdb
import pytest
from conftest import at
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from trip_marts.functions.casts import (
    amount,
    or_zero,
    safe_amount,
    safe_int,
    safe_timestamp,
)
from trip_marts.functions.keys import row_hash_key, surrogate_key
from trip_marts.functions.labels import payment_label
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
    month_text,
    weekday_number,
)


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def results(df, *columns):
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return [r[0] for r in rows] if len(columns) == 1 else rows


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def test_safe_int_rounds_floating_values_half_to_even(spark):
    df = column(spark, [0.5, 1.5, 2.5, 2.7, -0.5, 3e10, float("nan"), None], "double")
    assert results(df, safe_int(df, "x")) == [0, 2, 2, 3, 0, None, None, None]


def test_safe_int_rounds_decimals_and_text_half_away_from_zero(spark):
    df = column(spark, [Decimal("2.5"), Decimal("-2.5"), Decimal("2.4")], "decimal(18,3)")
    assert results(df, safe_int(df, "x")) == [3, -3, 2]
    df = column(spark, ["2.7", "2.5", "-2.5", "1e3", "x", " 7 ", "", None], "string")
    assert results(df, safe_int(df, "x")) == [3, 3, -3, 1000, None, 7, None, None]


def test_safe_int_of_integers(spark):
    df = column(spark, [5, 3_000_000_000, None], "bigint")
    assert results(df, safe_int(df, "X")) == [5, None, None]
    with pytest.raises(ValueError):
        safe_int(df, "absent")


def test_safe_timestamp(spark):
    df = column(spark, ["2023-01-01 10:00:00", "2023-01-01", "x", None], "string")
    expected = [at("2023-01-01 10:00:00"), at("2023-01-01"), None, None]
    assert results(df, safe_timestamp(F.col("x"))) == expected


def test_money_and_defaults(spark):
    df = column(spark, ["1.0025", "x", None], "string")
    assert results(df, or_zero(safe_amount(df, "x"))) == [Decimal("1.003"), 0, 0]
    df = column(spark, [Decimal("1.0025"), None], "decimal(18,4)")
    assert results(df, amount(df, "x")) == [Decimal("1.003"), None]
    with pytest.raises(ValueError):
        amount(df, "absent")


def test_floating_amounts_round_halves_away_from_zero(spark):
    values = [1.0025, 0.0005, -1.0025, 2.0005, 1e12, 0.0, -0.0, 0.00049, None]
    expected = ["1.003", "0.001", "-1.003", "2.001", "1000000000000.000", "0", "0", "0"]
    df = column(spark, values, "double")
    assert results(df, amount(df, "x")) == [*map(Decimal, expected), None]


def test_floating_amounts_agree_with_the_oracle_engine(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1e4, 1e4) for _ in range(2000)]
    values += [round(rng.uniform(-1e6, 1e6), rng.randrange(5)) for _ in range(5000)]
    values += [rng.randrange(-(10**6), 10**6) / 2000 for _ in range(5000)]
    listed = ", ".join(f"({v!r}::double)" for v in values)
    cast = f"SELECT v::decimal(18,3) FROM (VALUES {listed}) t(v)"
    expected = [r[0] for r in duckdb.connect().execute(cast).fetchall()]
    df = column(spark, values, "double").coalesce(1)
    assert results(df, amount(df, "x")) == expected


def test_amounts_that_are_no_numbers(spark):
    df = column(spark, [float("nan"), float("inf"), 1e16, -1e16, 2.0, None], "double")
    assert results(df, safe_amount(df, "x")) == [None, None, None, None, 2, None]
    for value in (float("nan"), 1e16):
        bad = column(spark, [value], "double")
        with pytest.raises(ArithmeticException):
            bad.select(amount(bad, "x")).collect()
    texts = ["1.5", " -1.5e1 ", ".5", "3.", "x", "", "1.2.3", None]
    df = column(spark, texts, "string")
    numbers = [Decimal(n) for n in ("1.500", "-15.000", "0.500", "3.000")]
    assert results(df, safe_amount(df, "x")) == [*numbers, None, None, None, None]


def test_row_hash_key_takes_nulls_as_empty_text(spark):
    df = spark.createDataFrame(
        [(at("2023-01-01 10:00:00"), None, 7, 1.5), (None, None, None, None)],
        "p timestamp_ntz, d timestamp_ntz, l bigint, x double",
    )
    key = row_hash_key(F.col("p"), F.col("d"), F.col("l"), amount(df, "x"))
    assert results(df, key) == [md5("2023-01-01 10:00:0071.500"), md5("")]


def test_row_hash_key_text_of_distance_does_not_depend_on_its_size(spark):
    df = column(spark, [1e7, 1e-2], "double")
    none = F.lit(None)
    assert results(df, row_hash_key(none, none, none, amount(df, "x"))) == [
        md5("10000000.000"),
        md5("0.010"),
    ]


def test_surrogate_key_marks_nulls(spark):
    df = spark.createDataFrame(
        [(1, at("2023-01-01 10:00:00")), (1, None)], "v bigint, p timestamp_ntz"
    )
    assert results(df, surrogate_key(F.col("v"), F.col("p"))) == [
        md5("1-2023-01-01 10:00:00"),
        md5("1-_dbt_utils_surrogate_key_null_"),
    ]


def test_payment_label(spark):
    df = column(spark, [1, 2, 3, 4, 5, 6, 9, 0, None], "int")
    assert results(df, payment_label(F.col("x"))) == [
        "Credit card",
        "Cash",
        "No charge",
        "Dispute",
        "Unknown",
        "Voided trip",
        "EMPTY",
        "EMPTY",
        "EMPTY",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_time_parts_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The second time does not exist in New York.
        times = [at("2023-01-01 00:30:00"), at("2023-03-12 02:30:00"), None]
        df = column(spark, times, "timestamp_ntz")
        x = F.col("x")
        parts = [month_start(x), month_text(x), weekday_number(x), hour_of_day(x)]
        assert results(df, *parts) == [
            (at("2023-01-01"), "2023-01", 0, 0),
            (at("2023-03-01"), "2023-03", 0, 2),
            (None, None, None, None),
        ]
        assert df.select(month_start(x).alias("m")).schema["m"].dataType.typeName() == (
            "timestamp_ntz"
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_minute_boundaries(spark):
    pairs = [
        ("2023-01-01 00:00:59", "2023-01-01 00:01:00", 1),
        ("2023-01-01 00:00:00", "2023-01-01 00:00:59.999999", 0),
        ("2023-01-01 23:59:30", "2023-01-02 00:00:10", 1),
        ("2023-01-31 00:00:00", "2023-03-01 01:01:00", 29 * 1440 + 61),
        ("2023-01-01 00:01:00", "2023-01-01 00:00:59", -1),
        ("2023-03-12 01:59:00", "2023-03-12 03:01:00", 62),
    ]
    df = spark.createDataFrame(
        [(at(a), at(b)) for a, b, _ in pairs], "a timestamp_ntz, b timestamp_ntz"
    )
    got = results(df, minute_boundaries(F.col("a"), F.col("b")))
    assert got == [expected for _, _, expected in pairs]


def test_measures(spark):
    df = spark.createDataFrame(
        [(Decimal("1.001"), Decimal("2.000")), (Decimal("2.001"), Decimal("0.000")), (None, None)],
        "a decimal(18,3), b decimal(18,3)",
    )
    a, b = F.col("a"), F.col("b")
    row = df.agg(
        exact_sum(a),
        exact_mean(a),
        ratio_of_sums(a, b),
        percent_of_rows(b > 0),
        mean_where(b > 0, a.cast("double")),
    ).first()
    assert tuple(row) == (Decimal("3.002"), 1.501, 1.501, 100 / 3, 1.001)


def test_measures_of_nothing_are_null(spark):
    df = column(spark, [], "decimal(18,3)")
    x = F.col("x")
    row = df.agg(exact_sum(x), exact_mean(x), ratio_of_sums(x, x)).first()
    assert tuple(row) == (None, None, None)


def test_ratio_with_zero_sum_is_null(spark):
    df = spark.createDataFrame([(Decimal("1"), Decimal("0"))], "a decimal(18,3), b decimal(18,3)")
    assert df.agg(ratio_of_sums(F.col("a"), F.col("b"))).first()[0] is None
