"""What the fact and its steps leave on disk: narrow shuffles, one compressed copy, nothing afterwards."""

from __future__ import annotations

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import driver_queries.queries as queries
from driver_queries.trips import raw_trips
from trip_marts.schemas import YELLOW
from trip_marts.sources.tables import shuffles_removed

ROWS = [
    ("Yellow", 1, datetime(1997, 4, 30, 10), 2.5),
    ("Yellow", 2, datetime(1997, 5, 3, 11), 1.0),
    ("Green", 3, datetime(1998, 12, 31, 23), 0.0),
    ("Green", 4, datetime(1999, 2, 1, 8), None),
    ("Yellow", 5, datetime(1999, 3, 4, 9), 4.0),
    ("Yellow", 6, None, 4.0),
]


def small_fact(spark, sf_dir="unused"):
    schema = "service_type string, tripid long, pickup_datetime timestamp_ntz, tip double"
    rows = spark.createDataFrame(ROWS, schema)
    return rows.withColumn("tip_amount", F.col("tip").cast("decimal(12,2)")).drop("tip")


def files(spark) -> set[Path]:
    root = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return {p for p in root.rglob("*") if p.is_file()}


def write_tables(spark, folder: Path) -> None:
    """A line of an order, with customer and supplier; the second order has no customer."""
    spark.sql(
        "SELECT * FROM VALUES (10L, 5L, 1, 2D, 9.5D, 0.1D, 0.2D, 'N', 'O', timestamp_ntz'1997-05-04 00:00:00'),"
        " (11L, 5L, 1, 2D, 9.5D, 0.1D, 0.2D, 'N', 'O', timestamp_ntz'1997-05-04 00:00:00') AS t(l_orderkey, l_suppkey,"
        " l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)"
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.sql(
        "SELECT * FROM VALUES (10L, 7L, timestamp_ntz'1997-05-01 00:00:00', '1-URGENT'),"
        " (11L, 99L, timestamp_ntz'1997-05-02 00:00:00', '2-HIGH') AS t(o_orderkey, o_custkey, o_orderdate, o_orderpriority)"
    ).write.parquet(f"{folder}/orders.parquet")
    # the same key twice gives the trip twice, as in any join
    spark.sql("SELECT * FROM VALUES (7L, 3), (7L, 4) AS t(c_custkey, c_nationkey)").write.parquet(f"{folder}/customer.parquet")
    spark.sql("SELECT * FROM VALUES (5L, 1) AS t(s_suppkey, s_nationkey)").write.parquet(f"{folder}/supplier.parquet")


def test_lines_are_not_shuffled_for_the_customers(spark, tmp_path, capsys):
    write_tables(spark, tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = raw_trips(spark, str(tmp_path), YELLOW)
        capsys.readouterr()
        trips.explain("formatted")
        nodes = capsys.readouterr().out.split("\n\n")
        by_customer = [n for n in nodes if "hashpartitioning(o_custkey" in n]
        assert len(by_customer) == 1
        assert "l_extendedprice" not in by_customer[0]
        assert sorted(r.DOLocationID for r in trips.collect()) == [3, 4]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_copy_of_the_fact_is_compressed_and_dropped(spark, lake, monkeypatch):
    monkeypatch.setattr(queries, "fact", small_fact)
    before = files(spark)
    with queries.fact_once(spark, "unused", lake) as trips:
        copied = trips.inputFiles()
        assert copied and all(".zstd." in name for name in copied)
        assert sorted(r.tripid for r in trips.collect()) == [1, 2, 3, 4, 5, 6]
        assert files(spark) == before  # nothing is checkpointed beside it
    assert not spark.catalog.tableExists(lake.table("fact_once"))


def test_the_copy_goes_also_when_a_step_fails(spark, lake, monkeypatch):
    monkeypatch.setattr(queries, "fact", small_fact)
    with pytest.raises(ZeroDivisionError), queries.fact_once(spark, "unused", lake):
        raise ZeroDivisionError
    assert not spark.catalog.tableExists(lake.table("fact_once"))


def test_incremental_load_leaves_only_its_table_on_disk(spark, monkeypatch):
    monkeypatch.setattr(queries, "fact", small_fact)
    before = files(spark)
    result = queries.QUERIES["incremental_load"](spark, "unused")
    # a null pickup is neither before the date nor above a mark
    assert sorted(r.tripid for r in result.collect()) == [1, 2, 3, 4, 5]
    kept = {p.parent.parent.parent.name for p in files(spark) - before if p.suffix == ".parquet"}
    assert kept == {"fact_trips"}
    assert not [p for p in files(spark) - before if "rdd-" in str(p)]


def test_shuffle_files_go_when_the_write_ends(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles() -> set[str]:
        found = disk.getAllFiles()
        names = [found.apply(i).getName() for i in range(found.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffles()
    with shuffles_removed(spark):
        spark.range(0, 1000, 1, 4).repartition(3, "id").write.parquet(f"{tmp_path}/t")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1000
