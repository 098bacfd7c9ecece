"""Month files, the zone seed, and landing of raw months."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trip_marts.functions.casts import amount
from trip_marts.functions.keys import row_hash_key
from trip_marts.functions.times import month_text
from trip_marts.schemas import (
    PICKUP_MONTH,
    ROW_KEY,
    SOURCE_FILE,
    TIMESTAMP,
    ZONE_SCHEMA,
    find_field,
    service_for,
)


@dataclass(frozen=True, order=True)
class MonthBatch:
    """One month of one service."""

    taxi_type: str
    year: int
    month: int

    @classmethod
    def of(cls, taxi_type: str, day: date) -> MonthBatch:
        """The batch a run date belongs to."""
        return cls(taxi_type, day.year, day.month)

    @property
    def first_day(self) -> date:
        return date(self.year, self.month, 1)

    @property
    def next_first_day(self) -> date:
        return date(self.year + self.month // 12, self.month % 12 + 1, 1)

    @property
    def source_key(self) -> str:
        """Path of the month's file below the source root."""
        year, month = f"{self.year:04d}", f"{self.month:02d}"
        name = f"{self.taxi_type}_tripdata_{year}-{month}.parquet"
        return f"{self.taxi_type}/{year}/{month}/{name}"

    @property
    def landing_key(self) -> str:
        """Directory of the landed copy, in partition naming."""
        return f"taxi_type={self.taxi_type}/year={self.year}/month={self.month}"


def month_range(taxi_type: str, first: date, last: date) -> Iterator[MonthBatch]:
    """Batches of every month from ``first`` to ``last``, in order."""
    batch = MonthBatch.of(taxi_type, first)
    while batch <= MonthBatch.of(taxi_type, last):
        yield batch
        batch = MonthBatch.of(taxi_type, batch.next_first_day)


def in_month(ts: Column, batch: MonthBatch) -> Column:
    """Whether a time falls in the batch's month, as a range files can skip on."""
    first = F.lit(str(batch.first_day)).cast(TIMESTAMP)
    end = F.lit(str(batch.next_first_day)).cast(TIMESTAMP)
    return (ts >= first) & (ts < end)


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files as one table, columns matched by name."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def scan_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone seed: quoted CSV with a header line; ``N/A`` stays text."""
    return spark.read.csv(path, header=True, schema=ZONE_SCHEMA, mode="FAILFAST")


def land_month(spark: SparkSession, source_root: str, landing_root: str, batch: MonthBatch) -> str:
    """Copy a month's raw rows into the landing area and return the directory.

    A map-only copy into the month's own directory: running it again replaces
    that month and nothing else.
    """
    target = f"{landing_root}/{batch.landing_key}"
    spark.read.parquet(f"{source_root}/{batch.source_key}").write.mode("overwrite").parquet(target)
    return target


def land_rows(df: DataFrame, landing_root: str, batch: MonthBatch) -> None:
    """Land raw rows as one month's batch, in the directory that ``land_month`` uses.

    All rows stay with their batch, whatever their pickup time, as they would in a
    month's file: running it again replaces that batch and nothing else.
    """
    df.write.mode("overwrite").parquet(f"{landing_root}/{batch.landing_key}")


def land_months(df: DataFrame, landing_root: str, taxi_type: str) -> None:
    """Land raw rows of any number of months in one job, each month as its own batch.

    Uses the same directories as ``land_rows``; batches of months in ``df`` are replaced,
    others stay. Rows without a pickup time make up a batch with null year and month.
    """
    pickup = F.col(service_for(taxi_type).pickup)
    rows = df.withColumns({"year": F.year(pickup), "month": F.month(pickup)})
    rows.hint("rebalance", "year", "month").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("year", "month").parquet(f"{landing_root}/taxi_type={taxi_type}")


def scan_landed(
    spark: SparkSession, landing_root: str, schema: StructType | None = None
) -> DataFrame:
    """All landed months; filters on type, year and month prune directories.

    Without a ``schema`` the columns of all files are merged, for which every
    file's footer has to be read; give one where there are many files.
    """
    if schema is None:
        return scan_parquet(spark, landing_root)
    return spark.read.schema(schema).parquet(landing_root)


def as_batch(df: DataFrame, taxi_type: str, source_file: str | None = None) -> DataFrame:
    """Raw rows plus row key, source file and pickup month.

    Without a ``source_file`` the path each row was read from is used.
    """
    service = service_for(taxi_type)
    pickup = F.col(_required(df, service.pickup))
    lineage = F.col("_metadata.file_path") if source_file is None else F.lit(source_file)
    key = row_hash_key(
        pickup,
        F.col(_required(df, service.dropoff)),
        F.col(_required(df, "PULocationID")),
        amount(df, "trip_distance"),
    )
    return df.select(
        key.alias(ROW_KEY),
        lineage.alias(SOURCE_FILE),
        *[F.col(name) for name in df.columns],
        month_text(pickup).alias(PICKUP_MONTH),
    )


def _required(df: DataFrame, name: str) -> str:
    field = find_field(df, name)
    if field is None:
        raise ValueError(f"raw rows have no column {name!r}")
    return field.name
