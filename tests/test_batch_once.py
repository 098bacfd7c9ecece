"""Upserts compute their batch once, however many steps read it."""

from __future__ import annotations

from pyspark.sql import functions as F
from rows import yellow

from trip_marts.operators.membership import KeyFilter, upsert_filtered
from trip_marts.sources.files import as_batch
from test_versions import day


def counted(spark, df):
    """``df`` with a column whose every computation adds one to the accumulator."""
    made = spark.sparkContext.accumulator(0)

    def seen(value):
        made.add(1)
        return value

    return df.withColumn("PULocationID", F.udf(seen, "long")("PULocationID")), made


def test_a_filtered_upsert_computes_its_batch_once(spark, lake):
    name, how = lake.table("t"), KeyFilter(bits=1 << 16)
    rows, made = counted(spark, yellow(spark, day("2023-01-10"), day("2023-02-10"), day("2023-02-11")))
    assert upsert_filtered(as_batch(rows, "yellow", source_file="f"), name, how) == []
    assert made.value == 3
    rows, made = counted(spark, yellow(spark, day("2023-01-10", fare_amount=3.0), day("2023-03-01")))
    assert upsert_filtered(as_batch(rows, "yellow", source_file="f"), name, how) == ["2023-01"]
    assert made.value == 2
    assert spark.table(name).count() == 4
