"""Helpers that the operators of this subpackage share: stable row ids, staged
tables in the cluster's shared folder and files written by tasks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.joins import BROADCAST_MAX_BYTES
from quire.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint folder, deleted when the JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jpath)
    fs.deleteOnExit(jpath)
    return fs.makeQualified(jpath).toString()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this session has staged and nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts the
    lineage, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, name)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _is_scan(df: DataFrame) -> bool:
    """Whether `df` is one file table with nothing but projections and filters above it,
    so that a file and a row number in it name a row of `df`."""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().apply(0)
    if node.nodeName() != "LogicalRelation":
        return False
    try:
        return len(df.select("_metadata.file_path", "_metadata.row_index").schema) == 2
    except AnalysisException:  # formats without row numbers
        return False


def with_uid(df: DataFrame, columns: list[str], uid: str = "uid") -> DataFrame:
    """`columns` of `df` and a unique row id that every evaluation of the
    result gives again, whatever the number of executors: rows read straight from
    files are numbered by the rank of their file's path and their place in the file,
    which do not depend on how files are split into tasks. Any other frame, and one
    of so many files that their names are beyond the broadcast bound, is written with its ids first."""
    files = [r[0] for r in df.select("_metadata.file_path").distinct().collect()] if _is_scan(df) else None
    if files is None or sum(len(f.encode()) + 8 for f in files) > BROADCAST_MAX_BYTES:
        return stage(df.select(*columns).withColumn(uid, F.monotonically_increasing_id()), "rows")
    ranks = df.sparkSession.createDataFrame(list(zip(sorted(files), range(len(files)))), "__file string, __rank long")
    rows = df.select(*columns, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__place"))
    return rows.join(F.broadcast(ranks), F.col("__path") == F.col("__file")) \
        .select(*columns, (F.shiftleft("__rank", 40) + F.col("__place")).alias(uid))


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int] | None:
    """glibc's malloc_trim; other C libraries have none."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return the memory that Arrow and malloc hold free to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def frugal(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`rows` for mapInArrow, giving back free memory when it ends: its worker goes
    on to other tasks, and would hold the largest batch of each operator until then."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(parts)
        finally:
            give_back()

    return run


TEXTS = 256  # Python strings that `texts` makes at once


def texts(column: pa.Array) -> Iterator[str | None]:
    """The strings of an Arrow column, a few at a time: a batch has thousands of documents."""
    for i in range(0, len(column), TEXTS):
        yield from column.slice(i, TEXTS).to_pylist()


def open_fs(uri: str):
    """pyarrow file system and path of a URI (file, hdfs, s3, gs ...)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """Output stream under a temporary name, moved into place at the end: a
    retried or speculative task never leaves a torn file under the final one."""

    def __init__(self, uri: str):
        self.fs, self.path = open_fs(uri)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temp)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def tell(self) -> int:
        return self.out.tell()

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.path)


def batches(columns: dict[str, list], schema: pa.Schema, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Record batches of at most `size` rows from column lists."""
    n = len(next(iter(columns.values())))
    for i in range(0, n, size):
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name][i:i + size], f.type) for f in schema], schema=schema)
