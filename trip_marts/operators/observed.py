"""Data checks gathered while a model is written, instead of by reading it again.

Counts of nulls, of values outside a list and of orphans come out of the writing job itself as
observed metrics. Only two things still read the stored model, and only its few columns
concerned: uniqueness, which has to bring equal keys together, and the number of
different unaccepted values where the job has seen any.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trip_marts.operators.quality import (
    ACCEPTED_VALUES,
    NOT_NULL,
    RELATIONSHIPS,
    UNIQUE,
    Check,
    duplicates,
    unaccepted,
)

REPORT_SCHEMA = "check_name string, model string, severity string, failures bigint"


def flagged(rows: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame]) -> tuple[DataFrame, list[str]]:
    """Rows with a column for each relationship check: whether the parent lacks their value.

    Parents are dimensions; the planner broadcasts them by measured size or joins by a
    skew-aware shuffle.
    """
    added = []
    for position, check in enumerate(checks):
        if check.kind != RELATIONSHIPS:
            continue
        (column,) = check.columns
        match, orphan = f"_match_{position}", f"_orphan_{position}"
        keys = parents[check.parent].select(F.col(check.parent_column).alias(match)).where(F.col(match).isNotNull())
        rows = rows.join(keys.distinct(), F.col(column) == F.col(match), "left_outer")
        rows = rows.withColumn(orphan, F.col(column).isNotNull() & F.col(match).isNull()).drop(match)
        added.append(orphan)
    return rows, added


def metric(check: Check, position: int) -> Column | None:
    """What is counted of a check while rows pass; None for uniqueness."""
    (column, *_) = check.columns
    if check.kind == NOT_NULL:
        return F.count_if(F.col(column).isNull())
    if check.kind == ACCEPTED_VALUES:
        return F.count_if(~F.col(column).isin(list(check.values)))
    if check.kind == RELATIONSHIPS:
        return F.count_if(F.col(f"_orphan_{position}"))
    if check.kind == UNIQUE:
        return None
    raise ValueError(f"unknown kind of check {check.kind!r}")


class WrittenChecks:
    """The checks of one model, to be gathered by the job that writes it."""

    def __init__(self, checks: Sequence[Check], parents: Mapping[str, DataFrame]) -> None:
        models = {check.model for check in checks}
        if len(models) != 1:
            raise ValueError(f"checks of one model are needed, not of {sorted(models)}")
        self.checks, self.parents = list(checks), parents
        self.observation = Observation(f"checks_{uuid4().hex}")
        self._metrics = {i: m for i, c in enumerate(self.checks) if (m := metric(c, i)) is not None}

    def attach(self, rows: DataFrame) -> DataFrame:
        """The same rows, counted as they pass; to be written by exactly one job."""
        if not self._metrics:
            return rows
        marked, added = flagged(rows, self.checks, self.parents)
        counts = [m.alias(f"m{i}") for i, m in self._metrics.items()]
        return marked.observe(self.observation, *counts).drop(*added).select(*rows.columns)

    def write(self, rows: DataFrame, write: Callable[[DataFrame], object], stored: Callable[[], DataFrame]) -> DataFrame:
        """Write rows by ``write`` and report their checks; ``stored`` reads them back."""
        write(self.attach(rows))
        return self.report(rows.sparkSession, stored())

    def report(self, spark: SparkSession, stored: DataFrame) -> DataFrame:
        """One row per check, as ``run_checks`` has it; waits for the writing job."""
        seen = self.observation.get if self._metrics else {}
        rows = []
        for i, check in enumerate(self.checks):
            if check.kind == UNIQUE:
                failures = duplicates(stored, *check.columns).count()
            elif check.kind == ACCEPTED_VALUES and seen[f"m{i}"]:
                (column,) = check.columns
                failures = unaccepted(stored, column, check.values).count()  # values, not rows
            else:
                failures = seen[f"m{i}"]
            rows.append((check.name, check.model, check.severity, failures))
        fields = [f.split() for f in REPORT_SCHEMA.split(", ")]
        reported = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields, strict=True)]) for row in rows]
        return spark.range(1).select(F.inline(F.array(*reported)))
