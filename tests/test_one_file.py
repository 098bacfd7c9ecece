"""The arrival files: one file each, the rows made by many tasks."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from driver_queries.queries import one_file


def test_one_file_keeps_the_join_spread(spark, tmp_path, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.createDataFrame([(k % 7, k) for k in range(200)], "key long, value long")
        keys = spark.createDataFrame([(k, f"k{k}") for k in range(7)], "key long, name string")
        rows = one_file(lines.join(keys, "key"))
        capsys.readouterr()
        rows.explain()
        plan = capsys.readouterr().out
        rows.write.parquet(str(tmp_path / "out"))
        written = spark.read.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SinglePartition" in plan and "Coalesce" not in plan
    assert len(list(Path(tmp_path / "out").glob("*.parquet"))) == 1
    assert written.count() == 200
    assert written.where(F.col("name") != F.concat(F.lit("k"), F.col("key").cast("string"))).count() == 0
