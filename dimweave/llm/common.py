"""What the operators of this subpackage share: tables, the shared work folder, word hashing, Arrow slices."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text a task works on at once, whatever the size of the batches Spark hands over.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder, removed when the driver ends, in the place driver and executors share.

    That is spark.checkpoint.dir, or the warehouse where the session names no such folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/dimweave-{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return str(files.makeQualified(path).toString())


def written(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """The frame as a table in a shared folder: lineage ends here and outlives lost executors.

    Tables of texts may ask for `zstd`, which takes a little more time and half the room.
    """
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def freed(spark: SparkSession) -> None:
    """Let go of the shuffles of jobs that are over: their files stay until the driver's heap is collected."""
    gc.collect()
    spark._jvm.System.gc()


#: Rows of a few numbers that may be broadcast, once counted. Beyond it the same join shuffles.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """A written narrow table, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about SLICE_BYTES of `column`, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        if values.nbytes <= SLICE_BYTES:
            yield batch
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(values), 0), dtype=np.int64)
        piece = np.cumsum(sizes) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield batch.slice(start, end - start)


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of MurmurHash3)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(33)
    x *= _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """64-bit hashes of words, kept for the words met last; emptied when it holds `limit` words."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` (up to 5) words, in order of place."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total += mix(hashes[i : i + n] + _ODD[i]) * _ODD[i]
    return mix(total)


def per_worker(name: str, make: Callable, version: str = ""):
    """What `make` returns, made once in a Python worker and kept for its later tasks.

    Only what was asked for last is kept: what earlier stages used goes.
    """
    kept = sys.modules.setdefault("dimweave_kept", types.ModuleType("dimweave_kept")).__dict__
    if kept.get("key") != (name, version):
        kept.pop("value", None)
        kept["key"], kept["value"] = None, make()
        kept["key"] = name, version
    return kept["value"]


def forget() -> None:
    """Drop what earlier stages keep in this worker, for a task that keeps nothing there itself."""
    kept = sys.modules.get("dimweave_kept")
    if kept is not None and kept.__dict__.pop("value", None) is not None:
        kept.key = None
        trim()


def trim() -> None:
    """Give memory that a task no longer needs back: its worker waits for later tasks beside others."""
    pa.default_memory_pool().release_unused()
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        return


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def hide(df: DataFrame, *names: str) -> DataFrame:
    """Without the columns that an operator is about to add: its results replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
