"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 300_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: bytes -> bytes: A-Z lower-cased, every byte outside words turned into a space.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null counts as the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def crc_mod(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as remainder 0 (held out)."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus, F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.  Where it is unset, a local session (tests) gets a folder of its own; a
    cluster's executors would not see that, so there it is an error."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new place in this application's folder, which Hadoop deletes with all that is in it when the driver ends."""
    home = f"{shared_dir(spark)}/corpus-{spark.sparkContext.applicationId}"
    if home not in _HOMES:
        place = spark._jvm.org.apache.hadoop.fs.Path(home)
        fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(place)
        fs.deleteOnExit(place)
        _HOMES.add(home)
    return f"{home}/{name}-{uuid.uuid4().hex}"


_HOMES: set[str] = set()


#: Folders of ``stored`` tables, newest list last; see ``scratch``.
_OPEN: list[list[str]] = []


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    schema = df.schema if not partition_by else None
    reader = df.sparkSession.read
    return (reader.schema(schema) if schema else reader).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end; what is returned from inside must have been stored outside or written
    elsewhere by then (``kept``)."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``stored`` for a table that outlives the innermost ``scratch``."""
    inner = _OPEN.pop() if _OPEN else None
    try:
        return stored(df, name)
    finally:
        if inner is not None:
            _OPEN.append(inner)


def small(df: DataFrame) -> DataFrame:
    """Broadcast up to ``BROADCAST_ROWS`` rows of ids or fingerprints (some 50 MB), joined by a shuffle beyond."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [b"" if x is None else x for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def column_list(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


class Numbered(dict):
    """word -> number of its first use."""

    def __missing__(self, key):
        self[key] = value = len(self)
        return value
