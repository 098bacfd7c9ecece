"""Partitioned tables whose every change is one commit.

A commit writes its partitions into a directory of its own and then names, in one small
manifest, the directories that make up the table. The manifest appears by one rename, so readers
see all changed partitions of a commit or none, whenever its driver is lost. Two
writers cannot both make the same version: the second one fails and can try again.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_marts.operators.upsert import same_partitions, upsert_rows
from trip_marts.schemas import PICKUP_MONTH, ROW_KEY, find_field
from trip_marts.sources.manifests import (
    Part,
    matching,
    names_in,
    read_manifest,
    read_parts,
    remove,
    write_once,
    written_parts,
)
from trip_marts.sources.tables import align_to, laid_out, wider_type

DAY_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Version:
    """What a manifest says."""

    number: int
    schema: T.StructType
    parts: list[Part]


@dataclass(frozen=True)
class VersionedTable:
    """A table below ``root``, in ``data/written_by_commit=…`` directories and ``manifests``."""

    root: str
    partition_by: tuple[str, ...] = (PICKUP_MONTH,)

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/v{number:010d}.json"

    def numbers(self, spark: SparkSession) -> list[int]:
        """Numbers of the versions that can be read, oldest first."""
        names = names_in(spark, f"{self.root}/manifests")
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def version(self, spark: SparkSession, number: int | None = None) -> Version | None:
        """The newest version or the one named; None before the first commit."""
        if number is None:
            numbers = self.numbers(spark)
            if not numbers:
                return None
            number = numbers[-1]
        found = read_manifest(spark, self._manifest(number))
        parts = [Part(tuple(p["values"]), p["path"]) for p in found["parts"]]
        return Version(number, T.StructType.fromJson(found["schema"]), parts)

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """Rows of a version, which later commits never change."""
        found = self.version(spark, number)
        if found is None:
            raise LookupError(f"no version below {self.root}")
        return read_parts(spark, self.data, found.parts, found.schema)

    def append(self, df: DataFrame) -> int:
        """Add rows; returns the new version's number."""
        return self._commit(df, None)

    def replace(self, df: DataFrame, touched: Column | None = None) -> int:
        """Swap the partitions that occur in ``df``; returns the new version's number.

        Partitions for which ``touched`` holds and that receive no rows are left out of
        the new version. ``df`` may be computed from the table itself.
        """
        return self._commit(df, F.lit(False) if touched is None else touched)

    def _commit(self, df: DataFrame, touched: Column | None) -> int:
        spark = df.sparkSession
        base = self.version(spark)
        schema = _merged_schema(base.schema if base else None, df, self.partition_by)
        rows = align_to(df, spark.createDataFrame([], schema))
        folder = f"written_by_commit={uuid4().hex}"
        laid_out(rows, self.partition_by).write.partitionBy(*self.partition_by).parquet(f"{self.data}/{folder}")
        made = written_parts(spark, self.data, folder, len(self.partition_by))
        stay = base.parts if base else []
        if touched is not None:
            gone = set(matching(spark, stay, self.partition_by, schema, touched))
            new = {p.values for p in made}
            stay = [p for p in stay if p not in gone and p.values not in new]
        number = base.number + 1 if base else 1
        content = {
            "schema": schema.jsonValue(),
            "parts": [{"values": list(p.values), "path": p.path} for p in [*stay, *made]],
        }
        write_once(spark, self._manifest(number), content)
        return number

    def clean(self, spark: SparkSession, keep: int = 2, grace_seconds: float = DAY_SECONDS) -> list[str]:
        """Drop all but the last ``keep`` versions and the directories that none of them names.

        What commits left behind that never ended goes too, once it is older than the
        grace time; younger directories may belong to a commit under way.
        """
        numbers = self.numbers(spark)
        for number in numbers[: max(0, len(numbers) - keep)]:
            remove(spark, self._manifest(number))
        used = {p.path.split("/")[0] for n in numbers[-keep:] for p in self.version(spark, n).parts}
        limit = (time.time() - grace_seconds) * 1000
        dropped = [n for n, changed in names_in(spark, self.data).items() if n not in used and changed <= limit]
        for name in dropped:
            remove(spark, f"{self.data}/{name}")
        return dropped


def _merged_schema(stored: T.StructType | None, df: DataFrame, partition_by: Sequence[str]) -> T.StructType:
    """Stored columns widened to hold ``df``, then its new columns; partition columns last."""
    fields = {f.name.lower(): f for f in (stored.fields if stored else [])}
    for field in df.schema.fields:
        have = fields.get(field.name.lower())
        kind = wider_type(have.dataType, field.dataType) if have else field.dataType
        if kind is None:
            kinds = f"{have.dataType.simpleString()} and {field.dataType.simpleString()}"
            raise ValueError(f"column {field.name!r}: no type holds {kinds}")
        fields[field.name.lower()] = T.StructField(have.name if have else field.name, kind)
    last = [c.lower() for c in partition_by]
    for column in partition_by:
        if find_field(df, column) is None:
            raise ValueError(f"rows have no column {column!r} to partition by")
    return T.StructType([f for k, f in fields.items() if k not in last] + [fields[k] for k in last])


def upsert_versioned(batch: DataFrame, table: VersionedTable, keys: Sequence[str] = (ROW_KEY,)) -> int:
    """Upsert a batch in one commit; returns the new version's number.

    Only partitions that the batch has rows in are read and written anew.
    """
    spark = batch.sparkSession
    if table.version(spark) is None:
        return table.replace(batch)
    stored = table.read(spark)
    affected = stored.where(same_partitions(batch, table.partition_by))
    return table.replace(upsert_rows(affected, batch, keys, table.partition_by[-1]))
