"""The stream with a ledger, and checks gathered while writing."""

from __future__ import annotations

import pytest
from conftest import at
from pyspark.sql import functions as F
from rows import yellow
from test_pipeline import contents

from trip_marts.operators import quality
from trip_marts.operators.membership import KeyFilter, upsert_filtered
from trip_marts.operators.observed import WrittenChecks
from trip_marts.operators.quality import ACCEPTED_VALUES, ERROR, NOT_NULL, RELATIONSHIPS, UNIQUE, Check, run_checks
from trip_marts.sources.tables import refresh_table
from trip_marts.streaming import arrivals
from trip_marts.streaming.arrivals import follow_arrivals, ledger_table


def day(text, **more):
    return {"pickup": at(f"{text} 08:00:00"), "dropoff": at(f"{text} 08:20:00"), **more}


@pytest.fixture
def places(tmp_path):
    return f"{tmp_path}/in", f"{tmp_path}/checkpoint"


def arrive(rows, folder, name):
    rows.coalesce(1).write.parquet(f"{folder}/{name}")


def run(spark, lake, places, **more):
    follow_arrivals(spark, places[0], "yellow", lake.raw("yellow"), places[1], **more).awaitTermination()
    return contents(spark.table(lake.raw("yellow")).select("pickup_month", "fare_amount"))


def test_files_arrive_grow_the_table_and_are_taken_once(spark, lake, places):
    arrive(yellow(spark, day("2023-01-10")), places[0], "a")
    assert run(spark, lake, places) == [("2023-01", 20.0)]
    wider = yellow(spark, day("2023-01-10", fare_amount=7.0), day("2023-02-10")).withColumn("cbd_fee", F.lit(0.75))
    arrive(wider.withColumn("passenger_count", F.col("passenger_count").cast("long")), places[0], "b")
    assert run(spark, lake, places) == [("2023-01", 7.0), ("2023-02", 20.0)]
    assert contents(spark.table(lake.raw("yellow")).select("cbd_fee")) == [(0.75,), (0.75,)]
    ledger = spark.table(ledger_table(lake.raw("yellow")))
    assert contents(ledger.select("batch_id", "rows")) == [(0, 1), (1, 2)]
    files = set(spark.table(lake.raw("yellow")).inputFiles())
    lost = places[0], places[1] + "_new"  # the checkpoint is lost: all files are delivered again
    assert run(spark, lake, lost, files_per_batch=10) == [("2023-01", 7.0), ("2023-02", 20.0)]
    assert set(spark.table(lake.raw("yellow")).inputFiles()) == files and ledger.count() == 2


def test_a_run_that_stops_before_its_record_is_repeated(spark, lake, places, monkeypatch):
    arrive(yellow(spark, day("2023-01-10")), places[0], "a")
    arrive(yellow(spark, day("2023-01-11")), places[0], "b")

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(arrivals, "append_rows", lost)
    with pytest.raises(Exception, match="driver lost"):
        run(spark, lake, places)
    monkeypatch.undo()
    assert spark.table(lake.raw("yellow")).count() == 1
    assert run(spark, lake, places) == [("2023-01", 20.0), ("2023-01", 20.0)]
    assert spark.table(ledger_table(lake.raw("yellow"))).count() == 2


def test_another_upsert_takes_the_files(spark, lake, places):
    arrive(yellow(spark, day("2023-01-10"), day("2023-02-10")), places[0], "a")
    arrive(yellow(spark, day("2023-02-11")), places[0], "b")
    rewritten = []

    def upsert(rows, table):
        rewritten.append(upsert_filtered(rows, table, KeyFilter(bits=1 << 16)))

    assert len(run(spark, lake, places, upsert=upsert)) == 3
    assert rewritten == [[], []]


# ---- checks gathered while writing

CHECKS = [
    Check(UNIQUE, "m", ("k",)),
    Check(NOT_NULL, "m", ("k",), severity=ERROR),
    Check(RELATIONSHIPS, "m", ("zone",), parent="zones", parent_column="id"),
    Check(RELATIONSHIPS, "m", ("k",), parent="zones", parent_column="id"),
    Check(ACCEPTED_VALUES, "m", ("code",), values=(1, 2)),
    Check(ACCEPTED_VALUES, "m", ("zone",), values=(1, 2, 3, 9)),
]


def models_of(spark, rows):
    zones = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    return {"m": spark.createDataFrame(rows, "k int, zone int, code int"), "zones": zones}


@pytest.mark.parametrize("rows", [[(1, 1, 1), (1, 2, 7), (2, 9, 7), (None, None, None), (3, 3, 8)], [(1, 1, 1), (2, 2, 2)], []])
def test_written_checks_equal_the_report(spark, lake, rows):
    models, name = models_of(spark, rows), lake.table("m")
    checks = WrittenChecks(CHECKS, models)
    report = checks.write(models["m"], lambda df: refresh_table(df, name), lambda: spark.table(name))
    assert contents(report) == contents(run_checks(models, CHECKS))
    assert contents(spark.table(name)) == contents(models["m"])
    if len(rows) > 2:
        with pytest.raises(quality.ChecksFailed):
            quality.enforce(report)


def test_passing_checks_read_nothing_again(spark, lake):
    models = models_of(spark, [(1, 1, 1), (2, 2, 2)])
    checks = WrittenChecks([c for c in CHECKS if c.kind != UNIQUE], models)
    rows = checks.attach(models["m"])
    rows.write.format("noop").mode("overwrite").save()
    report = checks.report(spark, stored=None)  # the stored model is not needed
    assert {r.failures for r in report.collect()} == {0}
    with pytest.raises(ValueError, match="one model"):
        WrittenChecks([Check(NOT_NULL, "a", ("k",)), Check(NOT_NULL, "b", ("k",))], {})
