"""Whole runs: ingest of months, and the build from raw tables to marts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from trip_marts.functions.times import month_text
from trip_marts.operators.incremental import (
    above,
    global_watermark,
    month_not_below,
    table_watermarks,
)
from trip_marts.operators.quality import (
    Check,
    enforce,
    revenue_check,
    run_checks,
    staging_checks,
    trip_id_check,
)
from trip_marts.operators.unions import SERVICE_TYPE
from trip_marts.operators.upsert import upsert_table
from trip_marts.plans.dimension import dim_zone
from trip_marts.plans.fact import fact_trips, with_pickup_month
from trip_marts.plans.marts import hourly_operation, monthly_zone_revenue, od_routes, tipping
from trip_marts.plans.partials import tipping_from_state, tipping_state
from trip_marts.plans.staging import stage_trips
from trip_marts.schemas import CREDIT_CARD, GREEN, PICKUP_MONTH, YELLOW, Service
from trip_marts.sources.files import MonthBatch, as_batch, land_month
from trip_marts.sources.snapshots import publish_snapshot
from trip_marts.sources.tables import (
    append_rows,
    create_like,
    partition_files,
    refresh_table,
    replace_exactly,
    table_exists,
)

# Table of the months whose marts are out of date, and its entry for all months.
PENDING = "pending_months"
# Table of the raw months as they were when the fact was loaded last.
LOADED = "loaded_months"
ALL_MONTHS = "all"
# Table of the tipping mart's counts and sums by month.
TIPPING_STATE = "tipping_state"
FACT_PARTITIONS = (SERVICE_TYPE, PICKUP_MONTH)
MARTS = {
    "dm_monthly_zone": monthly_zone_revenue,
    "dm_hourly_operation": hourly_operation,
    "dm_origin_destination": od_routes,
    "dm_tipping": tipping,
}
# Marts grouped by month, with the month column their tables are partitioned by.
MART_MONTHS = {
    "dm_monthly_zone": "revenue_month",
    "dm_hourly_operation": "report_month",
    "dm_origin_destination": "report_month",
}


@dataclass(frozen=True)
class BuildOptions:
    """How a build runs; the defaults give full and correct results.

    A build stages the raw months whose files changed since the last one, whatever
    the pickup times in them. ``reload_months`` names months (``yyyy-MM``) to stage
    as well. The checks of staging and fact cover the changed months, which is
    exact as trip ids never span months; ``check_months`` names others and
    ``check_all`` takes all of them.

    ``by_mark`` loads only trips later than the latest one of their service, which
    loses late rows and everything below a future-dated one.

    ``by_position``, ``global_mark`` and ``credit_label`` reproduce results of
    a load that matched columns by place, kept one mark for both services, or
    compared with another spelling of the card label.
    """

    full_refresh: bool = False
    sample_rows: int | None = None
    reload_months: tuple[str, ...] = ()
    check_staging: bool = True
    check_months: tuple[str, ...] = ()
    check_all: bool = False
    by_mark: bool = False
    by_position: bool = False
    global_mark: bool = False
    credit_label: str = CREDIT_CARD


@dataclass(frozen=True)
class Lake:
    """Names of the tables of one database."""

    database: str = "default"
    services: tuple[Service, Service] = field(default=(YELLOW, GREEN))

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def raw(self, taxi_type: str) -> str:
        return self.table(f"trips_{taxi_type}")


def ingest_month(
    spark: SparkSession, lake: Lake, source_root: str, landing_root: str, batch: MonthBatch
) -> None:
    """Land one month and upsert it into the raw table of its service."""
    landed = land_month(spark, source_root, landing_root, batch)
    rows = as_batch(spark.read.parquet(landed), batch.taxi_type, source_file=landed)
    upsert_table(rows, lake.raw(batch.taxi_type))


def backfill(
    spark: SparkSession,
    lake: Lake,
    source_root: str,
    landing_root: str,
    batches: Iterable[MonthBatch],
) -> None:
    """Ingest months one after another, in the given order.

    Each month is a complete job of its own and can be run again, so a stopped
    backfill resumes at the month it stopped at.
    """
    for batch in batches:
        ingest_month(spark, lake, source_root, landing_root, batch)


def trips_of(
    spark: SparkSession, lake: Lake, raw: list[DataFrame], options: BuildOptions
) -> DataFrame:
    """Fact rows of the given raw rows, one DataFrame per service."""
    staged = [
        stage_trips(rows, service, options.sample_rows)
        for rows, service in zip(raw, lake.services, strict=True)
    ]
    dim = spark.table(lake.table("dim_zone"))
    return with_pickup_month(fact_trips(*staged, dim, by_position=options.by_position))


def all_raw(spark: SparkSession, lake: Lake, months: tuple[str | None, ...] | None = None) -> list[DataFrame]:
    """The raw tables, whole or limited to some months."""
    tables = [spark.table(lake.raw(service.taxi_type)) for service in lake.services]
    return [t.where(in_months(F.col(PICKUP_MONTH), months)) for t in tables] if months is not None else tables


def in_months(month: Column, months: Iterable[str | None]) -> Column:
    """Whether a month text is one of those given, null being one too."""
    known = [m for m in months if m is not None]
    found = month.isin(*known) if known else F.lit(False)
    return found | month.isNull() if None in months else found


def raw_state(spark: SparkSession, lake: Lake) -> dict[tuple[str, str | None], str]:
    """Digest of the files of every raw month, by service and month."""
    return {
        (service.label, month): digest
        for service in lake.services
        for (month,), digest in partition_files(spark, lake.raw(service.taxi_type)).items()
    }


def loaded_state(spark: SparkSession, lake: Lake) -> dict[tuple[str, str | None], str]:
    """What ``raw_state`` was when the fact was loaded last."""
    if not table_exists(spark, lake.table(LOADED)):
        return {}
    return {(r[0], r[1]): r[2] for r in spark.table(lake.table(LOADED)).collect()}


def new_raw(spark: SparkSession, lake: Lake, global_mark: bool = False) -> list[DataFrame]:
    """Raw rows above the high-water marks of the fact.

    The marks apply ahead of the de-duplication, and their month prunes
    partitions; the pickup time is part of the de-duplication key, so the order
    of the two steps does not matter.
    """
    marks = table_watermarks(spark, lake.table("fact_trips"))
    newest = global_watermark(marks)
    rows = []
    for service, raw in zip(lake.services, all_raw(spark, lake), strict=True):
        mark = newest if global_mark else marks.get(service.label)
        if mark is not None:
            month, pickup = F.col(PICKUP_MONTH), F.col(service.pickup)
            raw = raw.where(month_not_below(month, mark) & above(pickup, mark))
        rows.append(raw)
    return rows


def load_fact(spark: SparkSession, lake: Lake, options: BuildOptions) -> None:
    """Bring the fact table up to date.

    The months about to change are noted first, so that the marts catch up even
    if the run ends before it reaches them.
    """
    table = lake.table("fact_trips")
    state = raw_state(spark, lake)
    if options.full_refresh or not table_exists(spark, table):
        note_pending(spark, lake, [ALL_MONTHS])
        rows = trips_of(spark, lake, all_raw(spark, lake), options)
        refresh_table(rows, table, FACT_PARTITIONS)
    elif options.by_mark or options.global_mark:
        raw = new_raw(spark, lake, options.global_mark)
        months = months_of(raw)
        if months:
            note_pending(spark, lake, months)
            append_rows(trips_of(spark, lake, raw, options), table)
        return
    else:
        loaded = loaded_state(spark, lake)
        changed = {k for k in state.keys() | loaded.keys() if state.get(k) != loaded.get(k)}
        named = {(s.label, m) for s in lake.services for m in options.reload_months}
        months = sorted({m for _, m in changed | named}, key=str)
        if months:
            note_pending(spark, lake, months)
            rows = trips_of(spark, lake, all_raw(spark, lake, tuple(months)), options)
            replace_exactly(rows, table, in_months(F.col(PICKUP_MONTH), months))
    rows = [(service, month, digest) for (service, month), digest in state.items()]
    schema = f"{SERVICE_TYPE} string, {PICKUP_MONTH} string, digest string"
    refresh_table(spark.createDataFrame(rows, schema).coalesce(1), lake.table(LOADED))


def note_pending(spark: SparkSession, lake: Lake, months: list[str | None]) -> None:
    """Add months to those the marts still have to catch up with."""
    noted = spark.createDataFrame([(m,) for m in months], f"{PICKUP_MONTH} string").coalesce(1)
    create_like(noted, lake.table(PENDING))
    append_rows(noted, lake.table(PENDING))


def pending_months(spark: SparkSession, lake: Lake) -> list[str | None] | None:
    """Months noted since the marts were last refreshed; None stands for all."""
    if not table_exists(spark, lake.table(PENDING)):
        return []
    rows = spark.table(lake.table(PENDING)).distinct().collect()
    months = sorted((row[0] for row in rows), key=str)
    return None if ALL_MONTHS in months else months


def months_of(raw: list[DataFrame]) -> list[str | None]:
    """Pickup months of the rows, one text per calendar month, null being one."""
    months = reduce(DataFrame.union, [rows.select(PICKUP_MONTH) for rows in raw]).distinct()
    return sorted((row[0] for row in months.collect()), key=str)


def refresh_marts(
    spark: SparkSession, lake: Lake, options: BuildOptions, months: list[str | None] | None = None
) -> None:
    """Recompute the marts from the stored fact, which is built only once.

    Given the months that changed, a mart grouped by month reads and replaces
    only those; its groups and ranks never span two months. The tipping mart, which
    has no month, is rolled up from monthly states kept in a table. None stands for
    all months.
    """
    fact = spark.table(lake.table("fact_trips"))
    for name, mart in MARTS.items():
        table, month = lake.table(name), MART_MONTHS.get(name)
        if month is None:
            refresh_tipping(spark, lake, options.credit_label, months)
        elif months is None or not table_exists(spark, table):
            refresh_table(mart(fact), table, (month,))
        elif months:
            rows = mart(fact.where(in_months(F.col(PICKUP_MONTH), months)))
            replace_exactly(rows, table, in_months(month_text(F.col(month)), months))


def refresh_tipping(
    spark: SparkSession, lake: Lake, credit_label: str = CREDIT_CARD, months: list[str | None] | None = None
) -> None:
    """Bring the monthly states up to date, reading changed months only, and roll them up."""
    fact, table = spark.table(lake.table("fact_trips")), lake.table(TIPPING_STATE)
    if months is None or not table_exists(spark, table):
        refresh_table(tipping_state(fact), table, (PICKUP_MONTH,))
    elif months:
        changed = in_months(F.col(PICKUP_MONTH), months)
        replace_exactly(tipping_state(fact.where(changed)), table, changed)
    refresh_table(tipping_from_state(spark.table(table), credit_label), lake.table("dm_tipping"))


def declared_checks(lake: Lake, staging: bool = True) -> list[Check]:
    checks = [trip_id_check("fact_trips"), revenue_check("dm_monthly_zone")]
    if staging:
        for service in lake.services:
            checks += staging_checks(f"stg_{service.taxi_type}", "dim_zone")
    return checks


def check_report(
    spark: SparkSession, lake: Lake, staging: bool = True, months: tuple[str | None, ...] | None = None
) -> DataFrame:
    """Result of every declared check, on all months or those given."""
    names = ["dim_zone", "fact_trips", "dm_monthly_zone"]
    models = {name: spark.table(lake.table(name)) for name in names}
    if months is not None:
        models["fact_trips"] = models["fact_trips"].where(in_months(F.col(PICKUP_MONTH), months))
    if staging:
        for service, raw in zip(lake.services, all_raw(spark, lake, months), strict=True):
            models[f"stg_{service.taxi_type}"] = stage_trips(raw, service)
    return run_checks(models, declared_checks(lake, staging))


def build(
    spark: SparkSession,
    lake: Lake,
    zones: DataFrame,
    options: BuildOptions = BuildOptions(),
    publish_root: str | None = None,
    publish: tuple[str, ...] = (),
) -> list[Row]:
    """Dimension, fact, marts, checks, and optionally a published snapshot.

    ``publish`` names the tables to publish, by default the dimension and the marts.
    Returns the checks that only warn. A failed check of error severity raises
    before anything is published.
    """
    refresh_table(dim_zone(zones), lake.table("dim_zone"))
    load_fact(spark, lake, options)
    pending = pending_months(spark, lake)
    months = options.check_months or (None if options.check_all or pending is None else tuple(pending))
    refresh_marts(spark, lake, options, pending)
    report = check_report(spark, lake, options.check_staging, months)
    warnings = enforce(report)  # months that fail stay pending
    if table_exists(spark, lake.table(PENDING)):
        refresh_table(spark.createDataFrame([], f"{PICKUP_MONTH} string"), lake.table(PENDING))
    if publish_root is not None:
        tables = [lake.table(name) for name in publish or ("dim_zone", *MARTS)]
        publish_snapshot(spark, tables, publish_root)
    return warnings
