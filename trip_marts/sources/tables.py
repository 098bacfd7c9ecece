"""Catalog tables: lookup, creation, refresh, append, partition replacement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_marts.schemas import find_field

# How the catalog writes a null partition value.
HIVE_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Stored tables and views of a database, without the session's own views."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def missing_tables(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """The given tables that do not exist, for readers that need all of them."""
    return [name for name in names if not table_exists(spark, name)]


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def create_like(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Create an empty table with the columns of ``df``, if there is none."""
    empty = df.limit(0).write.format("parquet").partitionBy(*partition_by)
    empty.mode("ignore").saveAsTable(table)


def refresh_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh: replace the table by ``df``; a failed one leaves it as it was.

    A partitioned table with the same columns has its partitions swapped when all
    rows are written. Any other table is computed into one of its own first and
    copied from there.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        _create(df, table, partition_by)
    elif partition_by and _same_layout(df, table, partition_by):
        replace_exactly(df, table, F.lit(True))
    else:
        following = f"{table}__next"
        spark.sql(f"DROP TABLE IF EXISTS {following}")
        _create(df, following, partition_by, like=table)
        _create(spark.table(following), table, partition_by, like=following)
        spark.sql(f"DROP TABLE {following}")


def _create(df: DataFrame, table: str, partition_by: Sequence[str], like: str | None = None) -> None:
    """Write ``df`` as a table; one that stands for ``like`` is stored in the same buckets."""
    number, columns, order = bucket_spec(df.sparkSession, like) if like else (0, [], [])
    rows = df.repartition(number, *columns) if number else laid_out(df, partition_by)
    writer = rows.write.format("parquet").partitionBy(*partition_by)
    if number:
        writer = writer.bucketBy(number, *columns)
        writer = writer.sortBy(*order) if order else writer
    properties = _properties(df.sparkSession, like) if number else {}
    writer.mode("overwrite").saveAsTable(table)
    for key, value in properties.items():
        df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r.key: r.value for r in found if r.key.isidentifier()}


def bucket_spec(spark: SparkSession, table: str) -> tuple[int, list[str], list[str]]:
    """Number of buckets, the columns that pick one, and their order; 0 for a table without."""
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    names = [described.get(k, "").strip("[]") for k in ("Bucket Columns", "Sort Columns")]
    columns, order = ([n.strip(" `") for n in text.split(",") if n.strip(" `")] for text in names)
    return int(described.get("Num Buckets", 0)), columns, order


def _same_layout(df: DataFrame, table: str, partition_by: Sequence[str]) -> bool:
    stored = df.sparkSession.table(table).schema
    same = {f.name: f.dataType for f in stored} == {f.name: f.dataType for f in df.schema}
    return same and partition_columns(df.sparkSession, table) == list(partition_by)


def partition_files(spark: SparkSession, table: str) -> dict[tuple[str | None, ...], str]:
    """Digest of the file names of each partition, without reading any file.

    Files never change once written, so a partition whose digest is the same has
    the same rows. The names are those that every query of the table lists.
    """
    columns = partition_columns(spark, table)
    found: dict[tuple[str | None, ...], list[str]] = {}
    for path in spark.table(table).inputFiles():
        parts = dict(x.split("=", 1) for x in path.split("/") if "=" in x)
        values = tuple(_partition_value(parts[c]) for c in columns)
        found.setdefault(values, []).append(path)
    return {k: hashlib.sha256("\n".join(sorted(v)).encode()).hexdigest() for k, v in found.items()}


def _partition_value(text: str) -> str | None:
    # file names escape the value, and the list of files escapes the names
    return None if text == HIVE_NULL_PARTITION else unquote(unquote(text))


def replace_exactly(df: DataFrame, table: str, touched: Column) -> None:
    """Replace all partitions for which ``touched`` holds by the rows of ``df``.

    Partitions that receive rows are swapped; then those that were to change and
    received none are removed, for which nothing has to be computed twice.
    """
    spark = df.sparkSession
    columns = partition_columns(spark, table)
    before = partition_files(spark, table)
    replace_partitions(df, table)
    after = partition_files(spark, table)
    same = [k for k in before if after.get(k) == before[k]]
    if same:
        kinds = spark.table(table).schema
        listed = spark.createDataFrame(same, ", ".join(f"`{c}` string" for c in columns))
        typed = listed.select(*[F.col(c).cast(kinds[c].dataType).alias(c) for c in columns])
        for row in typed.where(touched).collect():
            values = ", ".join(f"`{c}` = {_partition_literal(row[c])}" for c in columns)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({values})")
        spark.catalog.refreshTable(table)


def _partition_literal(value: object) -> str:
    return "null" if value is None else f"'{value}'"


def append_rows(df: DataFrame, table: str) -> None:
    """Add rows, matching columns by name."""
    spark = df.sparkSession
    rows = align_to(df, spark.table(table))
    laid_out(rows, partition_columns(spark, table)).write.insertInto(table)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions that occur in ``df``; all others stay.

    The rows may be computed from the table itself: new files are written
    beside the old ones and swapped in when the whole job has succeeded.
    """
    spark = df.sparkSession
    rows = laid_out(align_to(df, spark.table(table)), partition_columns(spark, table))
    with dynamic_overwrite(spark):
        rows.write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def laid_out(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by partition so that each write task fills few files.

    A rebalance rather than a repartition: a partition value that holds much of
    the data is spread over several tasks instead of ending up in one.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def align_to(df: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of ``target`` by name, in its order and types, absent ones null."""
    columns = []
    for field in target.schema.fields:
        source = find_field(df, field.name)
        value = F.lit(None) if source is None else F.col(f"`{source.name}`")
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def wider_type(stored: T.DataType, new: T.DataType) -> T.DataType | None:
    """The type that holds every value of both, None where there is none.

    Whole numbers widen to longer ones, to decimals and to double; decimals to
    longer decimals; float to double.
    """
    if stored == new or isinstance(new, T.NullType):
        return stored
    if isinstance(stored, T.NullType):
        return new
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
    a, b = type(stored), type(new)
    if a in whole and b in whole:
        return stored if whole.index(a) >= whole.index(b) else new
    floating = (T.FloatType, T.DoubleType)
    if (a in floating and b in (*floating, *whole)) or (b in floating and a in whole):
        return T.DoubleType()
    if T.DecimalType in (a, b) and {a, b} <= {T.DecimalType, *whole}:
        sizes = [(t.precision, t.scale) if isinstance(t, T.DecimalType) else (digits[type(t)], 0) for t in (stored, new)]
        scale = max(s for _, s in sizes)
        precision = max(p - s for p, s in sizes) + scale
        return T.DecimalType(precision, scale) if precision <= 38 else None
    return None


def widen_types(df: DataFrame, table: str) -> None:
    """Make the table's types hold the values of ``df``, or raise and name the column.

    Where a type has to grow the table is written once more, which happens when a
    source changes its schema and not with every batch.
    """
    spark = df.sparkSession
    target = spark.table(table)
    grown = {}
    for field in target.schema.fields:
        source = find_field(df, field.name)
        if source is None:
            continue
        wide = wider_type(field.dataType, source.dataType)
        if wide is None:
            kinds = f"{field.dataType.simpleString()} and {source.dataType.simpleString()}"
            raise ValueError(f"column {field.name!r} of {table}: no type holds {kinds}")
        if wide != field.dataType:
            grown[field.name] = F.col(f"`{field.name}`").cast(wide)
    if grown:
        refresh_table(target.withColumns(grown), table, partition_columns(spark, table))


def add_missing_columns(df: DataFrame, table: str) -> None:
    """Widen the table by the columns only ``df`` has; old rows read as null."""
    spark = df.sparkSession
    target = spark.table(table)
    new = [f for f in df.schema.fields if find_field(target, f.name) is None]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    with _setting(spark, OVERWRITE_MODE, "dynamic"):
        yield


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the shuffle files of each write when it ends, not when the driver next collects garbage."""
    with _setting(spark, SHUFFLE_CLEANUP, "true"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
