"""A large batch is written by more tasks than buckets, each holding one bucket only."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from test_versions import batch_of, contents, day

from trip_marts.operators.bucketed import Buckets, upsert_bucketed


def test_a_bucket_is_written_by_several_tasks(spark, lake):
    name, layout = lake.table("t"), Buckets(number=2, parts=2)
    first = batch_of(spark, *[day("2023-01-10", trip_distance=float(k % 13), VendorID=k) for k in range(60)])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        upsert_bucketed(first, name, layout)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    stored = spark.table(name).withColumn("file", F.input_file_name())
    bucket = F.regexp_extract("file", r"_(\d{5})(?:\.c\d+)?\.[^/]*parquet$", 1).cast("int")
    assert stored.where(bucket != F.pmod(F.hash("unique_row_id", "key_part"), F.lit(2))).count() == 0
    files = {row.file for row in stored.select("file").distinct().collect()}
    assert len(files) > layout.number and all(re.search(r"_0000[01]", f) for f in files)
    assert contents(spark.table(name).select(first.columns)) == contents(first)
