"""Every registered query against its SQL on the driver's smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__
from driver_queries import queries
from driver_queries.compare import connect_oracle, difference
from driver_queries.oracle import ORACLE
from driver_queries.trips import raw_trips
from trip_marts.schemas import GREEN, YELLOW
from trip_marts.sources.files import MonthBatch, in_month, scan_landed

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def oracle():
    return connect_oracle(DATA)


@pytest.mark.parametrize("name", queries.QUERIES)
def test_query_equals_its_sql(spark, oracle, name):
    assert difference(spark, oracle, DATA, name) is None


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(ORACLE)
    assert queries.QUERIES.items() <= __spark_entry__.queries().items()
    assert ORACLE.items() <= __spark_entry__.oracle_sql().items()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_results_do_not_depend_on_session_settings(spark, oracle):
    changed = {
        "spark.sql.session.timeZone": "America/New_York",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.timestampType": "TIMESTAMP_LTZ",
        "spark.sql.sources.partitionOverwriteMode": "static",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {name: spark.conf.get(name) for name in changed}
    names = ["hourly_operation", "od_routes", "upsert_table", "incremental_load", "dq_report"]
    try:
        for setting, value in changed.items():
            spark.conf.set(setting, value)
        found = {name: difference(spark, oracle, DATA, name) for name in names}
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)
    assert found == dict.fromkeys(names)


def test_every_month_is_landed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_folder", lambda spark: str(tmp_path / "landing"))
    queries.landed_months(spark, DATA)
    landed = scan_landed(spark, str(tmp_path / "landing"))
    for service in (YELLOW, GREEN):
        rows, month = raw_trips(spark, DATA, service), queries.RELOADED_MONTH
        batch = MonthBatch(service.taxi_type, month.year, month.month)
        strays = rows.where(in_month(queries.F.col(service.pickup), batch) & (queries.F.dayofmonth(service.pickup) == 28))
        own = landed.where(queries.F.col("taxi_type") == service.taxi_type)
        assert own.count() == rows.count() + strays.count()
        assert own.select("year", "month").distinct().count() > 2
