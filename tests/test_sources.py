from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from conftest import at
from pyspark.sql import functions as F
from rows import green, yellow

from trip_marts.schemas import GREEN, YELLOW, service_for
from trip_marts.sources.files import (
    MonthBatch,
    as_batch,
    in_month,
    land_month,
    land_rows,
    month_range,
    scan_landed,
    scan_parquet,
    scan_zones,
)
from trip_marts.sources.snapshots import latest_version, publish_snapshot, read_snapshot
from trip_marts.sources.tables import (
    add_missing_columns,
    align_to,
    append_rows,
    count_rows,
    create_like,
    list_tables,
    missing_tables,
    partition_columns,
    refresh_table,
    replace_partitions,
    table_exists,
)


def frame(spark, rows, schema="k string, v int"):
    return spark.createDataFrame(rows, schema)


def files_read(df):
    return [r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()]


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_month_batch_paths():
    batch = MonthBatch.of("green", date(2023, 4, 17))
    assert batch.source_key == "green/2023/04/green_tripdata_2023-04.parquet"
    assert batch.landing_key == "taxi_type=green/year=2023/month=4"


def test_month_range_crosses_years():
    months = list(month_range("yellow", date(2022, 11, 5), date(2023, 2, 1)))
    assert [(m.year, m.month) for m in months] == [(2022, 11), (2022, 12), (2023, 1), (2023, 2)]


def test_in_month_covers_the_whole_month_and_no_more(spark):
    times = ["2022-12-31 23:59:59.999999", "2022-12-01 00:00:00", "2023-01-01 00:00:00"]
    df = spark.createDataFrame([(at(t),) for t in times], "t timestamp_ntz")
    december = df.where(in_month(F.col("t"), MonthBatch("yellow", 2022, 12)))
    assert december.count() == 2


def test_scan_parquet_matches_columns_by_name(spark, tmp_path):
    frame(spark, [("a", 1)]).write.parquet(f"{tmp_path}/one")
    frame(spark, [(2, 0.5)], "v int, w double").write.parquet(f"{tmp_path}/two")
    both = scan_parquet(spark, f"{tmp_path}/one", f"{tmp_path}/two")
    assert contents(both.select("k", "v", "w")) == [("a", 1, None), (None, 2, 0.5)]


def test_scan_zones_reads_quoted_lines_and_keeps_not_available_text(spark, tmp_path):
    seed = tmp_path / "zones.csv"
    seed.write_bytes(
        b'"LocationID","Borough","Zone","service_zone"\r\n'
        b'1,"EWR","Airport, East","EWR"\r\n264,"Unknown","N/A","N/A"\r\n265,"N/A","Outside","N/A"\r\n'
    )
    assert contents(scan_zones(spark, str(seed))) == [
        (1, "EWR", "Airport, East", "EWR"),
        (264, "Unknown", "N/A", "N/A"),
        (265, "N/A", "Outside", "N/A"),
    ]


def test_land_month_replaces_only_its_own_month(spark, tmp_path):
    source, landing = f"{tmp_path}/source", f"{tmp_path}/landing"
    january, february = MonthBatch("yellow", 2023, 1), MonthBatch("yellow", 2023, 2)
    for batch in (january, february):
        yellow(spark, {}, {}).write.parquet(f"{source}/{batch.source_key}")
        land_month(spark, source, landing, batch)
    yellow(spark, {"VendorID": 5}).write.mode("overwrite").parquet(f"{source}/{january.source_key}")
    land_month(spark, source, landing, january)
    landed = scan_landed(spark, landing)
    assert contents(landed.groupBy("taxi_type", "year", "month").count()) == [
        ("yellow", 2023, 1, 1),
        ("yellow", 2023, 2, 2),
    ]
    assert landed.where("month = 1").first().VendorID == 5


def test_land_rows_keeps_strays_with_their_batch(spark, tmp_path):
    landing = f"{tmp_path}/landing"
    january, february = MonthBatch("yellow", 2023, 1), MonthBatch("yellow", 2023, 2)
    stray, nobody = {"pickup": at("2023-01-31 23:00:00")}, {"pickup": None}
    land_rows(yellow(spark, *[{}] * 10), landing, january)
    land_rows(green(spark, {}), landing, MonthBatch("green", 2023, 1))
    for _ in range(2):
        land_rows(yellow(spark, {"pickup": at("2023-02-03 00:00:00")}, stray, nobody), landing, february)
    landed = scan_landed(spark, landing)
    assert contents(landed.groupBy("taxi_type", "year", "month").count()) == [
        ("green", 2023, 1, 1),
        ("yellow", 2023, 1, 10),
        ("yellow", 2023, 2, 3),
    ]
    assert spark.read.parquet(f"{landing}/{january.landing_key}").count() == 10
    one_month = scan_landed(spark, landing, landed.schema).where("taxi_type = 'yellow' AND month = 2")
    assert one_month.count() == 3
    assert {Path(f).parent.name for f in files_read(one_month)} == {"month=2"}


def test_as_batch_adds_key_lineage_and_month(spark, tmp_path):
    yellow(spark, {}).write.parquet(f"{tmp_path}/month.parquet")
    df = spark.read.parquet(f"{tmp_path}/month.parquet")
    row = as_batch(df, "yellow").first()
    assert f"{tmp_path}/month.parquet" in row.source_file
    assert row.pickup_month == "2023-01"
    assert len(row.unique_row_id) == 32
    assert as_batch(df, "yellow", source_file="here").first().source_file == "here"


def test_as_batch_of_another_service_uses_plain_names(spark):
    assert service_for("yellow") is YELLOW and service_for("green") is GREEN
    df = frame(
        spark,
        [(at("2023-01-01 10:00:00"), at("2023-01-01 10:05:00"), 7, 1.5)],
        "pickup_datetime timestamp_ntz, Dropoff_Datetime timestamp_ntz, "
        "PULocationID bigint, trip_distance double",
    )
    assert as_batch(df, "fhv", "x").first().pickup_month == "2023-01"
    with pytest.raises(ValueError):
        as_batch(df, "yellow", "x")


def test_create_like_makes_an_empty_table_once(spark, lake):
    name = lake.table("t")
    df = frame(spark, [("a", 1)])
    create_like(df, name, ["k"])
    assert spark.table(name).count() == 0
    assert partition_columns(spark, name) == ["k"]
    append_rows(df, name)
    create_like(df, name, ["k"])
    assert count_rows(spark.table(name)).first().total_rows == 1


def test_catalog_lookup(spark, lake):
    assert not table_exists(spark, lake.table("t"))
    refresh_table(frame(spark, [("a", 1)]), lake.table("t"))
    assert table_exists(spark, lake.table("t"))
    assert list_tables(spark, lake.database) == ["t"]
    assert missing_tables(spark, [lake.table("t"), lake.table("u")]) == [lake.table("u")]


def test_refresh_table_replaces_everything(spark, lake):
    name = lake.table("t")
    refresh_table(frame(spark, [("a", 1), ("b", 2)]), name, ["k"])
    refresh_table(frame(spark, [("c", 3)]), name, ["k"])
    assert contents(spark.table(name).select("k", "v")) == [("c", 3)]


def test_align_to_matches_by_name_in_any_case(spark):
    target = frame(spark, [], "a int, b double, c string")
    source = frame(spark, [(1.0, 7)], "B float, A bigint")
    aligned = align_to(source, target)
    assert aligned.schema == target.schema
    assert contents(aligned) == [(7, 1.0, None)]


def test_later_file_with_more_columns_widens_the_table(spark, lake):
    name = lake.table("t")
    refresh_table(frame(spark, [("a", 1)], "p string, v int"), name, ["p"])
    wider = frame(spark, [("b", 2, 0.5)], "p string, v int, w double")
    add_missing_columns(wider, name)
    append_rows(wider, name)
    assert contents(spark.table(name).select("p", "v", "w")) == [("a", 1, None), ("b", 2, 0.5)]


def test_replace_partitions_computed_from_the_table_itself(spark, lake):
    name = lake.table("t")
    refresh_table(frame(spark, [("a", 1), ("b", 2), (None, 3)]), name, ["k"])
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        old = spark.table(name).where("k = 'a' OR k IS NULL")
        replace_partitions(old.withColumn("v", F.col("v") * 10), name)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    assert contents(spark.table(name).select("k", "v")) == [("a", 10), ("b", 2), (None, 30)]


def test_published_versions(spark, lake, tmp_path):
    root, name = f"{tmp_path}/published", lake.table("t")
    assert latest_version(spark, root) is None
    with pytest.raises(LookupError):
        read_snapshot(spark, root, "t")
    refresh_table(frame(spark, [("a", 1)]), name)
    first = publish_snapshot(spark, [name], root)
    refresh_table(frame(spark, [("b", 2)]), name)
    assert contents(read_snapshot(spark, root, "t")) == [("a", 1)]
    publish_snapshot(spark, [name], root)
    assert contents(read_snapshot(spark, root, "t")) == [("b", 2)]
    assert contents(read_snapshot(spark, root, "t", first)) == [("a", 1)]


def test_unrecorded_version_stays_invisible(spark, lake, tmp_path):
    root, name = f"{tmp_path}/published", lake.table("t")
    refresh_table(frame(spark, [("a", 1)]), name)
    first = publish_snapshot(spark, [name], root)
    frame(spark, [("half", 0)]).write.parquet(f"{root}/data/99999999/t")
    assert latest_version(spark, root) == first
