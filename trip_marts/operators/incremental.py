"""High-water marks and rows above them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_marts.operators.unions import SERVICE_TYPE
from trip_marts.schemas import PICKUP_MONTH, TIMESTAMP
from trip_marts.sources.tables import HIVE_NULL_PARTITION

PICKUP = "pickup_datetime"


def watermarks(target: DataFrame) -> dict[str, datetime]:
    """Latest pickup time of each service; none for an empty table.

    The result has one entry per service, so it is safe to collect.
    """
    marks = target.groupBy(SERVICE_TYPE).agg(F.max(PICKUP)).collect()
    return {service: mark for service, mark in marks if mark is not None}


def table_watermarks(spark: SparkSession, table: str) -> dict[str, datetime]:
    """Watermarks of a table partitioned by service and pickup month.

    Only each service's last month is read; which one that is comes from the
    catalog's list of partitions, without touching a file.
    """
    parts = F.str_to_map("partition", F.lit("/"), F.lit("="))
    service, month = parts[SERVICE_TYPE], parts[PICKUP_MONTH]
    last = (
        spark.sql(f"SHOW PARTITIONS {table}")
        .where(month != HIVE_NULL_PARTITION)
        .groupBy(service.alias(SERVICE_TYPE))
        .agg(F.max(month).alias(PICKUP_MONTH))
        .collect()
    )
    newest = F.lit(False)
    for service_type, newest_month in last:
        newest = newest | (
            (F.col(SERVICE_TYPE) == service_type) & (F.col(PICKUP_MONTH) == newest_month)
        )
    return watermarks(spark.table(table).where(newest))


def global_watermark(marks: dict[str, datetime]) -> datetime | None:
    """One mark over all services, as the first version of the load used."""
    return max(marks.values(), default=None)


def above(column: Column, mark: datetime) -> Column:
    """Whether a pickup time is later than the mark."""
    return column > timestamp_literal(mark)


def month_not_below(month: Column, mark: datetime) -> Column:
    """Partition filter that goes with ``above``."""
    return month >= f"{mark:%Y-%m}"


def newer_rows(df: DataFrame, marks: dict[str, datetime]) -> DataFrame:
    """Rows later than the mark of their own service.

    A service without a mark is new and is taken whole.
    """
    keep = ~F.col(SERVICE_TYPE).isin(list(marks)) if marks else F.lit(True)
    for service, mark in marks.items():
        keep = keep | ((F.col(SERVICE_TYPE) == service) & above(F.col(PICKUP), mark))
    return df.where(keep)


def timestamp_literal(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast(TIMESTAMP)
