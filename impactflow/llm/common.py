"""Helpers shared by the operators of this subpackage: scratch tables, column names, bytes of texts."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

_SHIPPED: dict[str, str] = {}

BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
BYTES, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ship(spark: SparkSession) -> None:
    """Put this package on the Python workers' path, wherever the driver found it.

    The archive is code only; Spark's own file server hands it to the executors. Whole texts make wide rows, so Arrow
    batches are held to BATCH_ROWS rows and about BATCH_BYTES bytes in this session: a task has a few megabytes on either side of the pipe.
    """
    context = spark.sparkContext
    if _SHIPPED.get("to") != context.applicationId:
        package = Path(__file__).resolve().parent.parent
        name = str(Path(tempfile.mkdtemp(prefix="package-")) / package.name)
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _SHIPPED["to"] = context.applicationId
    if int(spark.conf.get(BATCH)) > BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))
    spark.conf.set(BYTES, str(BATCH_BYTES))


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared scratch folder and read it back.

    This cuts the lineage with files that every executor can read, so a lost executor
    costs no more than its own tasks. The shuffle files of the job that wrote the table
    are removed as soon as it is done.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for file in table.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that an operator is about to add (case does not matter)."""
    taken = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in taken]
    return df.drop(*clash) if clash else df


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and its n + 1 offsets; null is empty."""
    large = pa.large_binary()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string()).view(large)
    else:
        column = column.cast(large)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy of the bytes with A-Z lower-cased, all others as they are."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] |= 32
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text comes alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, ends = bytes_of(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + most, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work on the batches of a task, at whose end the worker gives what it has freed back to the system.

    A worker process stays for the tasks that follow, of other stages too. Else it would keep the most that any of them
    has taken, in pieces that do not fit the next, beside the executor's heap.
    """

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Return freed memory of Arrow's and of the C library's allocator to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        trim(0)


def binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf.rstrip('/')}/{table}.parquet")


def partitions_for(spark: SparkSession, data_bytes: int, each: int) -> int:
    """So many shuffle partitions that one holds about ``each`` bytes."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, -(-int(data_bytes) // each))


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text column over all rows."""
    row = df.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()
    return int(row[0] or 0)
