"""Small files that name what belongs to a version, written whole or not at all.

Paths are those of any file system Hadoop knows. Only names and manifests pass through the
driver, never rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Any
from urllib.parse import unquote
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trip_marts.sources.tables import HIVE_NULL_PARTITION

Values = tuple[str | None, ...]


class ConcurrentCommit(Exception):
    """Another writer has taken the version; read it and try again."""


@dataclass(frozen=True)
class Part:
    """One partition: its values as text, and its directory below the data folder."""

    values: Values
    path: str
    digest: str = ""


def _path(spark: SparkSession, path: str) -> Any:
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str) -> Any:
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Names in a folder and when they last changed, in milliseconds; empty if there is none."""
    files, path = _files(spark, folder), _path(spark, folder)
    if not files.exists(path):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in files.listStatus(path)}


def remove(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def write_once(spark: SparkSession, path: str, content: dict) -> None:
    """Write a manifest under a name that nobody else has taken.

    It is written beside its place and renamed, which either happens as a whole or fails.
    """
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/_{name}.{uuid4().hex}"
    out = _files(spark, path).create(_path(spark, draft), False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _files(spark, path).getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, draft), _path(spark, path), options)
    except Py4JJavaError as error:
        remove(spark, draft)
        if "FileAlreadyExists" in str(error.java_exception):
            raise ConcurrentCommit(path) from None
        raise


def read_manifest(spark: SparkSession, path: str) -> dict:
    jvm = spark.sparkContext._jvm
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def written_parts(spark: SparkSession, data: str, folder: str, depth: int) -> list[Part]:
    """The partitions a write has made below ``data``/``folder``, ``depth`` columns deep."""
    found = [((), folder)]
    for _ in range(depth):
        found = [
            ((*values, _value(name)), f"{path}/{name}")
            for values, path in found
            for name in names_in(spark, f"{data}/{path}")
            if "=" in name
        ]
    return [Part(values, path) for values, path in found]


def _value(name: str) -> str | None:
    text = name.split("=", 1)[1]
    return None if text == HIVE_NULL_PARTITION else unquote(text)


def read_parts(spark: SparkSession, data: str, parts: list[Part], schema: T.StructType) -> DataFrame:
    """Rows of the partitions, wherever below ``data`` each of them lies.

    Filters on partition columns prune directories as in any partitioned folder.
    """
    if not parts:
        return spark.createDataFrame([], schema)
    paths = [f"{data}/{p.path}" for p in parts]
    rows = spark.read.schema(schema).option("basePath", data).parquet(*paths)
    return rows.select(*[F.col(f"`{name}`") for name in schema.names])


def matching(spark: SparkSession, parts: list[Part], columns: tuple[str, ...], schema: T.StructType, touched: Column) -> list[Part]:
    """The partitions for whose values a condition holds; decided without reading rows."""
    if not parts or not columns:
        return list(parts)
    names = ", ".join(f"`{c}` string" for c in columns)
    listed = spark.createDataFrame([(*p.values, i) for i, p in enumerate(parts)], f"{names}, _at int")
    typed = listed.select("_at", *[F.col(f"`{c}`").cast(schema[c].dataType).alias(c) for c in columns])
    return [parts[r[0]] for r in typed.where(touched).select("_at").collect()]
