"""Published read-only copies of finished tables.

A version is one manifest that names the directories of its tables' partitions. Publishing
copies only the partitions whose files changed since the version before and names the
older directories for all others. The manifest is written last and in one step, so
readers never see a half-written version.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import UTC, datetime
from functools import reduce
from operator import and_, or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_marts.sources.manifests import (
    Part,
    Values,
    names_in,
    read_manifest,
    read_parts,
    remove,
    write_once,
    written_parts,
)
from trip_marts.sources.tables import partition_columns, partition_files


def publish_snapshot(
    spark: SparkSession, tables: Sequence[str], root: str, version: str | None = None
) -> str:
    """Publish the tables as a new version below ``root`` and return its name."""
    version = version or datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
    numbers = _numbers(spark, root)
    before = _manifest(spark, root, numbers[-1])["tables"] if numbers else {}
    content = {
        "version": version,
        "published_at": datetime.now(UTC).isoformat(),
        "tables": {_short(t): _published(spark, t, root, version, before.get(_short(t))) for t in tables},
    }
    write_once(spark, _manifest_path(root, numbers[-1] + 1 if numbers else 1), content)
    return version


def _published(spark: SparkSession, table: str, root: str, version: str, before: dict | None) -> dict:
    """The manifest's entry of a table, after its changed partitions have been copied."""
    rows = spark.table(table)
    columns, schema = partition_columns(spark, table), rows.schema.jsonValue()
    same_layout = before is not None and (before["schema"], before["columns"]) == (schema, columns)
    old = {tuple(p["values"]): p for p in before["parts"]} if same_layout else {}
    now = partition_files(spark, table)
    kept = {v: p for v, p in old.items() if now.get(v) == p["digest"]}
    changed = [v for v in now if v not in kept]
    made: list[Part] = []
    if changed:
        folder = f"table_of={_short(table)}/published_in={version}-{uuid4().hex[:8]}"
        copied = rows.where(_one_of(changed, columns, rows.schema)) if kept else rows
        copied.write.partitionBy(*columns).parquet(f"{root}/data/{folder}")
        made = written_parts(spark, f"{root}/data", folder, len(columns))
    new = [{"values": list(p.values), "path": p.path, "digest": now[p.values]} for p in made]
    return {"schema": schema, "columns": columns, "parts": [*kept.values(), *new]}


def _one_of(values: list[Values], columns: Sequence[str], schema: T.StructType) -> Column:
    """Filter to some partitions; values are months and services, a short list."""
    if not columns:
        return F.lit(True)

    def same(own: Values) -> Column:
        each = zip(columns, own, strict=True)
        return reduce(and_, [F.col(c).eqNullSafe(F.lit(v).cast(schema[c].dataType)) for c, v in each])

    return reduce(or_, [same(own) for own in values])


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The version published last, whatever its name; None before the first publish."""
    numbers = _numbers(spark, root)
    return _manifest(spark, root, numbers[-1])["version"] if numbers else None


def read_snapshot(
    spark: SparkSession, root: str, table: str, version: str | None = None
) -> DataFrame:
    """A published table, from the newest version unless one is named."""
    for number in reversed(_numbers(spark, root)):
        found = _manifest(spark, root, number)
        if version in (None, found["version"]):
            break
    else:
        raise LookupError(f"no version {version or ''} published below {root}")
    entry = found["tables"].get(_short(table))
    if entry is None:
        raise LookupError(f"version {found['version']} has no table {table!r}")
    parts = [Part(tuple(p["values"]), p["path"], p["digest"]) for p in entry["parts"]]
    return read_parts(spark, f"{root}/data", parts, T.StructType.fromJson(entry["schema"]))


@contextmanager
def held(spark: SparkSession, root: str, version: str) -> Iterator[str]:
    """Keep a version from being removed while it is read."""
    path = f"{root}/holds/{uuid4().hex}.json"
    write_once(spark, path, {"version": version})
    try:
        yield version
    finally:
        remove(spark, path)


def remove_versions(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove all versions but the last ``keep`` and those held; returns their names.

    Directories that a remaining version still names stay. Not to be run while a
    version is being published, whose directories no manifest names yet.
    """
    in_use = {read_manifest(spark, f"{root}/holds/{n}")["version"] for n in names_in(spark, f"{root}/holds") if n[0] != "_"}
    numbers = _numbers(spark, root)
    old = numbers[: max(0, len(numbers) - keep)]
    dropped = {n: v for n in old if (v := _manifest(spark, root, n)["version"]) not in in_use}
    for number in dropped:
        remove(spark, _manifest_path(root, number))
    used = {
        "/".join(part["path"].split("/")[:2])
        for number in numbers
        if number not in dropped
        for entry in _manifest(spark, root, number)["tables"].values()
        for part in entry["parts"]
    }
    for table in names_in(spark, f"{root}/data"):
        for folder in names_in(spark, f"{root}/data/{table}"):
            if f"{table}/{folder}" not in used:
                remove(spark, f"{root}/data/{table}/{folder}")
    return list(dropped.values())


def _short(table: str) -> str:
    return table.split(".")[-1]


def _manifest_path(root: str, number: int) -> str:
    return f"{root}/published/p{number:010d}.json"


def _manifest(spark: SparkSession, root: str, number: int) -> dict:
    return read_manifest(spark, _manifest_path(root, number))


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = names_in(spark, f"{root}/published")
    return sorted(int(n[1:-5]) for n in names if n.startswith("p") and n.endswith(".json"))
