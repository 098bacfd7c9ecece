"""Physical plans: what is pruned, pushed down, pre-aggregated and split."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from driver_queries.queries import QUERIES
from driver_queries.trips import fact, raw_trips
from trip_marts.operators.dedup import first_per_key
from trip_marts.operators.upsert import matched_rows, unmatched_rows
from trip_marts.plans import marts
from trip_marts.plans.fact import with_pickup_month
from trip_marts.schemas import YELLOW
from trip_marts.sources.tables import refresh_table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="driver tables not present")


@contextmanager
def settings(spark, changes):
    before = {name: spark.conf.get(name, None) for name in changes}
    for name, value in changes.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def final_plan(df, capsys) -> str:
    """The plan after adaptive execution."""
    df.collect()
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows(spark, capsys, name):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(QUERIES[name](spark, DATA), capsys)
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "Python" not in plan


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark, capsys):
    plan = plan_of(QUERIES["stage_trips"](spark, DATA), capsys)
    tree = plan[: plan.index("(1)")] + plan[plan.index("WindowGroupLimit") :]
    assert tree.count("WindowGroupLimit") >= 2
    assert tree.index("WindowGroupLimit") < tree.index("Exchange", tree.index("WindowGroupLimit"))


def test_hot_key_reaches_its_reducer_as_one_row_per_task(spark):
    rows = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    first = first_per_key(rows, ["k"], ["v"])
    assert first.count() == 20001
    assert first.where("k = 0").first().v == 0


def test_month_scan_pushes_the_range_and_prunes_columns(spark, capsys):
    plan = plan_of(QUERIES["month_partition_scan"](spark, DATA), capsys)
    assert "GreaterThanOrEqual(o_orderdate,1997-05-01T00:00)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_zone_joins_are_broadcast_and_optional(spark, capsys):
    assert "BroadcastHashJoin" in plan_of(fact(spark, DATA), capsys)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(fact(spark, DATA), capsys)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_marts_aggregate_before_they_shuffle_and_read_few_columns(spark, lake, capsys):
    name = lake.table("fact_trips")
    refresh_table(with_pickup_month(fact(spark, DATA)), name, ("service_type", "pickup_month"))
    stored = spark.table(name)
    for mart in (marts.monthly_zone_revenue, marts.hourly_operation, marts.tipping):
        plan = plan_of(mart(stored), capsys)
        assert plan.count("Exchange") == 2  # once in the tree, once in the details
        assert "partial_count" in plan
        assert "tripid" not in plan
    one_month = stored.where("pickup_month = '1997-05' AND service_type = 'Green'")
    plan = plan_of(marts.tipping(one_month), capsys)
    assert "PartitionFilters: [isnotnull(pickup_month" in plan
    assert "pickup_month" not in plan[plan.index("ReadSchema") :].split("\n")[0]


def test_top_zones_never_sort_everything(spark, capsys):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_zones"](spark, DATA), capsys)


SPLIT_EARLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("join", [matched_rows, unmatched_rows])
def test_hot_row_key_is_split_in_the_upsert_join(spark, tmp_path, capsys, join):
    """A third of the table and of the batch share one key."""

    def stored(rows, name):
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        spark.range(0, rows, 1, 8).select(
            F.md5(hot.cast("string")).alias("unique_row_id"),
            F.lit("2023-01").alias("pickup_month"),
            F.col("id").alias("v"),
        ).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    table, batch = stored(300_000, "table"), stored(150_000, "batch")
    with settings(spark, SPLIT_EARLY):
        result = join(table, batch, ["unique_row_id"])
        plan = final_plan(result, capsys)
    assert "SortMergeJoin(skew=true)" in plan
    # Ids 0, 3, 6, ... share the hot key; of the others the batch has the lower half.
    assert result.count() == (200_000 if join is matched_rows else 100_000)


def test_hot_month_is_written_in_several_files(spark, lake):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("x"), F.lit("2023-01").alias("pickup_month")
    )
    with settings(spark, SPLIT_EARLY):
        refresh_table(rows, lake.table("t"), ("pickup_month",))
    assert len(spark.table(lake.table("t")).inputFiles()) > 4


def test_raw_trips_read_only_the_columns_they_use(spark, capsys):
    plan = plan_of(raw_trips(spark, DATA, YELLOW), capsys)
    assert "o_totalprice" not in plan and "s_name" not in plan and "l_partkey" not in plan
    assert "EqualTo(l_linestatus,O)" in plan
