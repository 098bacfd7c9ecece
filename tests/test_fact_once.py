"""Queries that write the fact in several steps compute it once."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import driver_queries.queries as queries


def fact_rows(spark):
    """A small fact whose every computation of a row adds one to the accumulator."""
    made = spark.sparkContext.accumulator(0)

    def seen(value):
        made.add(1)
        return value

    rows = [
        ("Yellow", 1, datetime(1997, 4, 30, 10), 2.5),
        ("Yellow", 2, datetime(1997, 5, 3, 11), 1.0),
        ("Green", 3, datetime(1998, 12, 31, 23), 0.0),
        ("Green", 4, datetime(1999, 2, 1, 8), 3.0),
        ("Yellow", 5, datetime(1999, 3, 4, 9), 4.0),
    ]
    schema = "service_type string, tripid long, pickup_datetime timestamp_ntz, tip double"
    df = spark.createDataFrame(rows, schema)
    counted = F.udf(seen, "long").asNondeterministic()
    tip = F.col("tip").cast("decimal(12,2)").alias("tip_amount")
    return df.select("service_type", counted("tripid").alias("tripid"), "pickup_datetime", tip), made


def test_the_fact_is_computed_once(spark, monkeypatch):
    rows, made = fact_rows(spark)
    monkeypatch.setattr(queries, "fact", lambda spark, sf_dir: rows)
    result = queries.QUERIES["incremental_load"](spark, "unused")
    assert sorted(r.tripid for r in result.collect()) == [1, 2, 3, 4, 5]
    assert made.value == 5


def test_tipping_partials_computes_the_fact_once(spark, monkeypatch):
    rows, made = fact_rows(spark)
    monkeypatch.setattr(queries, "fact", lambda spark, sf_dir: rows)
    # the rollup reads the stored table only; it stands in for it here
    rollup = lambda spark, lake, months=None: spark.range(1).write.mode("overwrite").saveAsTable(lake.table("dm_tipping"))
    monkeypatch.setattr(queries, "refresh_tipping", rollup)
    queries.QUERIES["tipping_partials"](spark, "unused")
    assert made.value == 5
