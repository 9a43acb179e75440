"""Shared folder, table access and Arrow batch helpers of the operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of word and text contracts, as a regular expression class.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Without the setting a local master gets a folder below its warehouse, since
    there driver and executors are one process; a cluster must have the setting.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors.  The files go when
    the driver ends; ``forget`` drops them earlier.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _file_system(spark, path)[0].deleteOnExit(_file_system(spark, path)[1])
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the files of frames that ``written`` returned and nothing reads any more."""
    for df in frames:
        fs, path = _file_system(df.sparkSession, df._shared_path)
        fs.delete(path, True)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; keeps partitions and their order."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def hex_sha256(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def crc32_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column; nulls are empty."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def _give_back() -> None:
    """Free memory of this Python worker goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which its Python worker, which waits for the next task, gives free memory back to the system."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


def given_back_each(run: Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    """As ``given_back``, of a function of groups, after each group."""

    def wrapped(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        try:
            return run(key, table)
        finally:
            _give_back()

    return wrapped


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each, or of one row."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to
