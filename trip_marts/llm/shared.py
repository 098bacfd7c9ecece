"""What the corpus operators share: tables, the shared folder, batches of texts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that are turned into arrays at once; a longer text comes alone.
PIECE_CHARS = 1 << 19
#: Texts that are, so that many short ones stay small too.
PIECE_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    `spark.checkpoint.dir` names it. Where that is unset, only a local session
    may go on: it uses a folder in its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_corpus_scratch"


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written below the shared folder and read back: lineage ends there."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_saved(df: DataFrame) -> None:
    """Delete the files of a `saved` table that no later result reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    root = shared_root(spark)
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "-" in path.rsplit("/", 1)[1] and root.split(":")[-1].lstrip("/") in path:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Runs of at most `PIECE_ROWS` rows with at most `PIECE_CHARS` bytes of text, or one row.

    Only one run's texts are Python strings at a time.
    """
    whole = batch.column(batch.schema.get_field_index(column))
    lo, size = 0, 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(whole), 0).to_pylist()):
        if size and (size + length > PIECE_CHARS or i - lo == PIECE_ROWS):
            piece = batch.slice(lo, i - lo)
            yield piece, texts_of(piece, column)
            lo, size = i, 0
        size += length + 1
    if lo < batch.num_rows:
        piece = batch.slice(lo)
        yield piece, texts_of(piece, column)


def map_texts(
    df: DataFrame, schema: str, each: Callable[[pa.RecordBatch, list[str]], dict], column: str = "text"
) -> DataFrame:
    """Rows that `each` makes of every piece, as columns of `schema`."""
    spark_schema = DataFrameSchema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = spark_schema.arrow()
        for batch in batches:
            for piece, texts in pieces(batch, column):
                made = each(piece, texts)
                yield pa.record_batch([pa.array(made[f.name], f.type) if not isinstance(made[f.name], pa.Array) else made[f.name].cast(f.type) for f in fields], schema=fields)

    return df.mapInArrow(run, schema)


class DataFrameSchema:
    """Arrow form of a flat DDL schema; made once per task."""

    KINDS = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
        "array<int>": pa.list_(pa.int32()), "array<float>": pa.list_(pa.float32()),
        "array<string>": pa.list_(pa.string()),
    }

    def __init__(self, ddl: str) -> None:
        self.ddl = ddl

    def arrow(self) -> pa.Schema:
        pairs = [part.strip().split(" ", 1) for part in self.ddl.split(",")]
        return pa.schema([(name, self.KINDS[kind.strip()]) for name, kind in pairs])


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, once for each Spark context."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="corpus-")) / "trip_marts_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))  # the driver serves it; only this copy is local
        _shipped.add(context.applicationId)
    return spark


_shipped: set[str] = set()
