"""Data checks with warn or error severity.

A check's failures are counted the usual way for such tests: duplicated keys
and values outside a list count once per value, nulls and orphans once per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from trip_marts.schemas import ACCEPTED_PAYMENT_CODES

WARN, ERROR = "warn", "error"
UNIQUE, NOT_NULL = "unique", "not_null"
RELATIONSHIPS, ACCEPTED_VALUES = "relationships", "accepted_values"
N_RECORDS = "n_records"


@dataclass(frozen=True)
class Check:
    """One assertion on the columns of a model."""

    kind: str
    model: str
    columns: tuple[str, ...]
    severity: str = WARN
    parent: str | None = None
    parent_column: str | None = None
    values: tuple[int | str, ...] = ()

    @property
    def name(self) -> str:
        return "_".join([self.kind, self.model, *self.columns])


class ChecksFailed(Exception):
    """At least one check of error severity has failures."""


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Keys occurring more than once, with their row count; null keys skipped."""
    return (
        df.where(all_present(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias(N_RECORDS))
        .where(F.col(N_RECORDS) > 1)
    )


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value is absent from the parent; null values pass."""
    keys = parent.select(F.col(parent_column).alias(column))
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def unaccepted(df: DataFrame, column: str, values: Sequence[int | str]) -> DataFrame:
    """Values outside the list, with their row count; nulls pass."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(N_RECORDS))
    )


def all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, model, severity, failures.

    All checks of a model that look at single rows share one grouping of it;
    uniqueness needs its own.
    """
    parts = []
    for model in dict.fromkeys(check.model for check in checks):
        own = [check for check in checks if check.model == model]
        single = [check for check in own if check.kind != UNIQUE]
        if single:
            parts.append(_single_row_checks(models, model, single))
        for check in own:
            if check.kind == UNIQUE:
                repeated = duplicates(models[model], *check.columns)
                parts.append(_report(repeated.agg(F.count(F.lit(1)).alias(check.name)), [check]))
    return reduce(DataFrame.unionByName, parts)


def _single_row_checks(
    models: Mapping[str, DataFrame], model: str, checks: Sequence[Check]
) -> DataFrame:
    """Counts of all the checks, from one grouping of the model.

    The rows are first reduced to the distinct combinations of what the checks
    look at, each with its row count, so a value shared by many rows never
    reaches a join more than once per combination.
    """
    looked_at = {}
    for check in checks:
        (column,) = check.columns
        missing = check.kind == NOT_NULL
        name = f"_missing_{column}" if missing else column
        looked_at[name] = (F.col(column).isNull() if missing else F.col(column)).alias(name)
    rows = models[model].groupBy(*looked_at.values()).agg(F.count(F.lit(1)).alias(N_RECORDS))

    counts = []
    for position, check in enumerate(checks):
        (column,) = check.columns
        if check.kind == NOT_NULL:
            failures = rows_where(F.col(f"_missing_{column}"))
        elif check.kind == ACCEPTED_VALUES:
            value = F.col(column)
            failures = F.count_distinct(F.when(~value.isin(list(check.values)), value))
        elif check.kind == RELATIONSHIPS:
            match = f"_match_{position}"
            keys = models[check.parent].select(F.col(check.parent_column).alias(match)).distinct()
            rows = rows.join(keys, F.col(column) == F.col(match), "left_outer")
            failures = rows_where(F.col(column).isNotNull() & F.col(match).isNull())
        else:
            raise ValueError(f"unknown kind of check {check.kind!r}")
        counts.append(failures.alias(check.name))
    return _report(rows.agg(*counts), checks)


def rows_where(condition: Column) -> Column:
    """Rows behind the combinations that meet a condition."""
    return F.coalesce(F.sum(F.when(condition, F.col(N_RECORDS))), F.lit(0))


def _report(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Turn one row of named counts into one row per check."""
    rows = [
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(check.model).alias("model"),
            F.lit(check.severity).alias("severity"),
            F.col(check.name).alias("failures"),
        )
        for check in checks
    ]
    return counts.select(F.inline(F.array(*rows)))


def enforce(report: DataFrame) -> list[Row]:
    """Failed checks that only warn; raises if one of error severity failed.

    The report has one row per declared check, so it is safe to collect.
    """
    failed = report.where(F.col("failures") > 0).collect()
    errors = [row for row in failed if row.severity == ERROR]
    if errors:
        text = ", ".join(f"{row.check_name}: {row.failures}" for row in errors)
        raise ChecksFailed(text)
    return failed


def staging_checks(model: str, zones: str) -> list[Check]:
    """What every staging model is expected to satisfy."""
    return [
        Check(UNIQUE, model, ("tripid",)),
        Check(NOT_NULL, model, ("tripid",)),
        Check(
            RELATIONSHIPS,
            model,
            ("pickup_locationid",),
            parent=zones,
            parent_column="locationid",
        ),
        Check(
            RELATIONSHIPS,
            model,
            ("dropoff_locationid",),
            parent=zones,
            parent_column="locationid",
        ),
        Check(ACCEPTED_VALUES, model, ("payment_type",), values=tuple(ACCEPTED_PAYMENT_CODES)),
    ]


def revenue_check(model: str) -> Check:
    """The monthly total must never be null; a null one stops the run."""
    return Check(NOT_NULL, model, ("revenue_monthly_total_amount",), severity=ERROR)


def trip_id_check(model: str) -> Check:
    """Trip ids are unique within a service only."""
    return Check(UNIQUE, model, ("service_type", "tripid"))
