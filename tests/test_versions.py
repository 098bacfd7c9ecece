"""Commits, snapshots, buckets, key filters, monthly states: what is read, written and kept."""

from __future__ import annotations

import pytest
from conftest import at
from pyspark.sql import functions as F
from rows import yellow, zones
from test_pipeline import contents, deliver, ingest_two_months, roots  # noqa: F401

from trip_marts.operators import bucketed, membership
from trip_marts.operators.bucketed import Buckets, upsert_bucketed
from trip_marts.operators.membership import KeyFilter, upsert_filtered
from trip_marts.operators.upsert import same_partitions, upsert_rows
from trip_marts.plans import marts, partials
from trip_marts.plans.pipeline import BuildOptions, build, in_months, ingest_month
from trip_marts.schemas import CREDIT_CARD_AS_WRITTEN, GREEN, YELLOW
from trip_marts.sources import manifests, versioned
from trip_marts.sources.files import as_batch
from trip_marts.sources.manifests import ConcurrentCommit
from trip_marts.sources.snapshots import held, publish_snapshot, read_snapshot, remove_versions
from trip_marts.sources.tables import bucket_spec, partition_files, refresh_table
from trip_marts.sources.versioned import VersionedTable, upsert_versioned


def rows_of(spark, *values):
    return spark.createDataFrame(list(values), "k string, v int, pickup_month string")


def batch_of(spark, *changes):
    return as_batch(yellow(spark, *changes), "yellow", source_file="f")


def day(text, **more):
    return {"pickup": at(f"{text} 08:00:00"), "dropoff": at(f"{text} 08:20:00"), **more}


# ---- versioned tables


def test_a_commit_shows_all_changed_partitions_or_none(spark, tmp_path, monkeypatch):
    table = VersionedTable(f"{tmp_path}/t")
    assert table.version(spark) is None
    assert table.replace(rows_of(spark, ("a", 1, "2023-01"), ("b", 2, "2023-02"), ("n", 3, None))) == 1
    changed = rows_of(spark, ("a", 10, "2023-01"), ("b", 20, "2023-02"))

    def lost(*_):
        raise KeyboardInterrupt  # the driver ends when both partitions lie there, before the manifest

    monkeypatch.setattr(versioned, "write_once", lost)
    with pytest.raises(KeyboardInterrupt):
        table.replace(changed)
    monkeypatch.undo()
    assert contents(table.read(spark)) == [("a", 1, "2023-01"), ("b", 2, "2023-02"), ("n", 3, None)]
    assert len(manifests.names_in(spark, table.data)) == 2
    assert len(table.clean(spark, grace_seconds=0)) == 1  # what the lost commit left behind
    assert table.replace(changed) == 2
    assert contents(table.read(spark)) == [("a", 10, "2023-01"), ("b", 20, "2023-02"), ("n", 3, None)]
    assert contents(table.read(spark, 1)) == [("a", 1, "2023-01"), ("b", 2, "2023-02"), ("n", 3, None)]


def test_emptied_partitions_leave_and_new_columns_come(spark, tmp_path):
    table = VersionedTable(f"{tmp_path}/t")
    table.replace(rows_of(spark, ("a", 1, "2023-01"), ("b", 2, "2023-02")))
    wider = spark.createDataFrame([("c", 2**40, "2023-01", "x")], "k string, v long, pickup_month string, w string")
    table.replace(wider, F.col("pickup_month") <= "2023-02")
    assert contents(table.read(spark).select("k", "v", "w", "pickup_month")) == [("c", 2**40, "x", "2023-01")]
    table.append(rows_of(spark, ("d", 4, "2023-01")))
    assert contents(table.read(spark).select("k", "w")) == [("c", "x"), ("d", None)]
    assert table.numbers(spark) == [1, 2, 3]
    table.clean(spark, keep=1, grace_seconds=0)
    assert table.numbers(spark) == [3] and table.read(spark).count() == 2
    with pytest.raises(ValueError, match="no type holds"):
        table.append(spark.createDataFrame([("e", "text", "2023-01")], "k string, v string, pickup_month string"))


def test_two_writers_cannot_make_one_version(spark, tmp_path, monkeypatch):
    table = VersionedTable(f"{tmp_path}/t")
    table.replace(rows_of(spark, ("a", 1, "2023-01")))
    seen = table.version(spark)
    table.append(rows_of(spark, ("b", 2, "2023-01")))
    monkeypatch.setattr(VersionedTable, "version", lambda self, spark, number=None: seen)
    with pytest.raises(ConcurrentCommit):
        table.append(rows_of(spark, ("c", 3, "2023-01")))
    monkeypatch.undo()
    assert contents(table.read(spark).select("k")) == [("a",), ("b",)]
    assert not [n for n in manifests.names_in(spark, f"{table.root}/manifests") if n.startswith("_")]


def test_versioned_upsert_reads_the_months_of_the_batch(spark, tmp_path):
    table = VersionedTable(f"{tmp_path}/t")
    first = batch_of(spark, day("2023-01-10"), day("2023-02-10"), day("2023-02-11"))
    again = batch_of(spark, day("2023-02-10", fare_amount=9.0))
    upsert_versioned(first, table)
    before = {p.values: p.path for p in table.version(spark).parts}
    upsert_versioned(again, table)
    after = {p.values: p.path for p in table.version(spark).parts}
    assert before[("2023-01",)] == after[("2023-01",)] and before[("2023-02",)] != after[("2023-02",)]
    expected = upsert_rows(first, again).select(sorted(first.columns))
    assert contents(table.read(spark).select(sorted(first.columns))) == contents(expected)


# ---- snapshots


def test_a_publish_copies_changed_months_only(spark, lake, tmp_path):
    root, name = f"{tmp_path}/published", lake.table("t")
    refresh_table(rows_of(spark, ("a", 1, "2023-01"), ("b", 2, "2023-02"), ("n", 3, None)), name, ("pickup_month",))
    first = publish_snapshot(spark, [name], root)
    spark.sql(f"INSERT INTO {name} PARTITION (pickup_month = '2023-02') VALUES ('c', 4)")
    second = publish_snapshot(spark, [name], root)
    (folder,) = [n for n in manifests.names_in(spark, f"{root}/data/table_of=t") if second in n]
    assert list(manifests.names_in(spark, f"{root}/data/table_of=t/{folder}")) in (["pickup_month=2023-02", "_SUCCESS"], ["_SUCCESS", "pickup_month=2023-02"])
    assert contents(read_snapshot(spark, root, "t", first)) == [("a", 1, "2023-01"), ("b", 2, "2023-02"), ("n", 3, None)]
    assert contents(read_snapshot(spark, root, "t").select("k")) == [("a",), ("b",), ("c",), ("n",)]
    assert read_snapshot(spark, root, "t").where("pickup_month = '2023-01'").count() == 1


def test_versions_go_unless_they_are_held(spark, lake, tmp_path):
    root, name = f"{tmp_path}/published", lake.table("t")
    versions = []
    for month in ("2023-01", "2023-02", "2023-03"):
        refresh_table(rows_of(spark, ("a", 1, "2023-01"), ("b", 2, month)), name, ("pickup_month",))
        versions.append(publish_snapshot(spark, [name], root))
    with held(spark, root, versions[0]):
        assert remove_versions(spark, root) == [versions[1]]
        assert read_snapshot(spark, root, "t", versions[0]).count() == 2
    assert remove_versions(spark, root) == [versions[0]]
    with pytest.raises(LookupError):
        read_snapshot(spark, root, "t", versions[0])
    assert contents(read_snapshot(spark, root, "t").select("k", "pickup_month")) == [("a", "2023-01"), ("b", "2023-03")]


# ---- buckets


def test_stored_rows_are_not_shuffled(spark, lake, capsys):
    name = lake.table("t")
    layout = Buckets(number=4, parts=3)
    first = batch_of(spark, *[day("2023-01-10", trip_distance=float(k % 7), VendorID=k) for k in range(40)], day("2023-02-10"))
    upsert_bucketed(first, name, layout)
    assert bucket_spec(spark, name) == (4, ["unique_row_id", "key_part"], ["unique_row_id"])
    again = batch_of(spark, day("2023-01-10", trip_distance=3.0, fare_amount=1.0), day("2023-01-11"))
    untouched = partition_files(spark, name)[("2023-02",)]
    keyed = again.withColumn("key_part", bucketed.key_part(sorted(again.columns), layout))
    stored = spark.table(name).where(same_partitions(again, ["pickup_month"]))
    capsys.readouterr()
    bucketed.unmatched_stored(stored, keyed, layout).explain()
    plan = capsys.readouterr().out
    left = plan[: plan.index("FileScan")]
    assert "SortMergeJoin" in left and "Exchange" not in left and "Bucketed: true" in plan
    upsert_bucketed(again, name, layout)
    expected = upsert_rows(first, again).select(first.columns)
    assert contents(spark.table(name).select(first.columns)) == contents(expected)
    assert partition_files(spark, name)[("2023-02",)] == untouched
    hot = spark.table(name).where("pickup_month = '2023-01'").groupBy("unique_row_id").agg(F.count_distinct("key_part").alias("parts"))
    assert hot.agg(F.max("parts")).first()[0] == 3  # rows of one key lie in several buckets


def test_buckets_outlast_wider_types_and_other_settings(spark, lake):
    name = lake.table("t")
    first = batch_of(spark, day("2023-01-10"), day("2023-01-11")).withColumn("PULocationID", F.col("PULocationID").cast("int"))
    upsert_bucketed(first, name, Buckets(number=3, parts=2))
    again = batch_of(spark, day("2023-01-10", fare_amount=7.0)).withColumn("extra_column", F.lit("x"))
    upsert_bucketed(again, name, Buckets(number=9, parts=1))  # the table keeps its own layout
    assert bucket_spec(spark, name)[0] == 3
    assert dict(spark.table(name).dtypes)["PULocationID"] == "bigint"
    assert contents(spark.table(name).select("fare_amount", "extra_column")) == [(20.0, None), (7.0, "x")]


# ---- key filters


def test_months_without_a_match_are_appended_to(spark, lake):
    name, how = lake.table("t"), KeyFilter(bits=1 << 16)
    assert upsert_filtered(batch_of(spark, day("2023-01-10"), day("2023-02-10"), {"pickup": None}), name, how) == []
    before = {k: set(v) for k, v in files_of(spark, name).items()}
    late = batch_of(spark, day("2023-01-15"))
    assert upsert_filtered(late, name, how) == []  # one late row: nothing is rewritten
    after = {k: set(v) for k, v in files_of(spark, name).items()}
    assert all(before[k] <= after[k] for k in before) and len(after["2023-01"]) > len(before["2023-01"])
    again = batch_of(spark, day("2023-01-15", fare_amount=1.0), day("2023-02-16"), {"pickup": None, "fare_amount": 5.0})
    assert upsert_filtered(again, name, how) == ["2023-01", None]
    assert not after["2023-01"] & set(files_of(spark, name)["2023-01"]) and before["2023-02"] <= set(files_of(spark, name)["2023-02"])
    shown = contents(spark.table(name).select("pickup_month", "fare_amount"))
    assert shown == [("2023-01", 1.0), ("2023-01", 20.0), ("2023-02", 20.0), ("2023-02", 20.0), (None, 5.0)]


def files_of(spark, name):
    found = {}
    for path in spark.table(name).inputFiles():
        found.setdefault(path.split("pickup_month=")[1].split("/")[0], []).append(path)
    return found


def test_a_full_filter_rewrites_and_changes_nothing_else(spark, lake):
    name, how = lake.table("t"), KeyFilter(bits=64, hashes=1)
    changes = [day(f"2023-01-{1 + k % 28:02d}", trip_distance=float(k)) for k in range(200)]
    upsert_filtered(batch_of(spark, *changes), name, how)
    late = batch_of(spark, day("2023-01-15", trip_distance=1e6))
    assert upsert_filtered(late, name, how) == ["2023-01"]  # a false positive
    assert spark.table(name).count() == 201


def test_filters_of_a_table_that_had_none(spark, lake):
    name, how = lake.table("t"), KeyFilter(bits=1 << 16)
    first = batch_of(spark, day("2023-01-10"), day("2023-02-10"))
    refresh_table(first, name, ("pickup_month",))
    assert upsert_filtered(batch_of(spark, day("2023-01-10", fare_amount=3.0)), name, how) == ["2023-01"]
    assert contents(spark.table(name).select("fare_amount")) == [(20.0,), (3.0,)]
    words = spark.table(membership.filter_table(name))
    assert words.selectExpr("sum(bit_count(bits))").first()[0] <= 6


# ---- monthly states


def test_tipping_states_of_unchanged_months_stay(spark, lake, roots, capsys):  # noqa: F811
    ingest_two_months(spark, lake, roots)
    build(spark, lake, zones(spark))
    state = lake.table("tipping_state")
    before = partition_files(spark, state)
    changed = day("2023-02-10", fare_amount=50.0, tip_amount=1.0)
    many = [{**changed, "VendorID": k} for k in range(30)]
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 2, *many))
    build(spark, lake, zones(spark))
    after = partition_files(spark, state)
    assert before[("2023-01",)] == after[("2023-01",)] and before[("2023-02",)] != after[("2023-02",)]
    fact = spark.table(lake.table("fact_trips"))
    stored = spark.table(lake.table("dm_tipping"))
    assert contents(stored) == contents(marts.tipping(fact)) != []
    capsys.readouterr()
    partials.tipping_state(fact.where(in_months(F.col("pickup_month"), ["2023-02"]))).explain()
    filters = capsys.readouterr().out.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "pickup_month" in filters and "2023-02" in filters
    build(spark, lake, zones(spark), BuildOptions(credit_label=CREDIT_CARD_AS_WRITTEN))
    as_written = spark.table(lake.table("dm_tipping"))
    assert contents(as_written) == contents(marts.tipping(fact, CREDIT_CARD_AS_WRITTEN))


def test_states_roll_up_to_other_groups(spark, lake, roots):  # noqa: F811
    many = [day("2023-01-10", VendorID=k, tip_amount=float(k % 5), payment_type=1 + k % 2) for k in range(60)]
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 1, *many))
    ingest_month(spark, lake, *roots, deliver(spark, roots, YELLOW, 2023, 2, *[{**m, **day("2023-02-10")} for m in many]))
    ingest_month(spark, lake, *roots, deliver(spark, roots, GREEN, 2023, 1, day("2023-01-10")))
    build(spark, lake, zones(spark))
    fact = spark.table(lake.table("fact_trips"))
    keys = ("pickup_zone",)
    rolled = partials.tipping_from_state(partials.tipping_state(fact, keys), group_by=keys)
    plain = marts.tipping(fact, group_by=keys)
    rounded = [F.round(c, 9).alias(c) if c == "avg_tip_percentage" else F.col(c) for c in plain.columns]
    assert contents(rolled.select(rounded)) == contents(plain.select(rounded)) != []
