"""Helpers that several training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.session import small_batches, work_path

_scratch: list[str] = []


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session; every exchange here is sized by it. Sets the bound on batches for Python, which operators call this before."""
    small_batches(spark)
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on one machine, one of our own where it is unset."""
    return work_path(spark, "x").rpartition("/")[0]


def scratch(spark: SparkSession) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/tabulon-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """df, written once below the shared folder and read back: cuts the lineage and outlives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free(spark: SparkSession) -> None:
    """Let Spark drop shuffle files whose results have been written: it does so for plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    with contextlib.suppress(Exception):
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Delete what scratch() gave out so far; only for callers that have written their results elsewhere."""
    while _scratch:
        delete(spark, _scratch.pop())


def repeated(df: DataFrame, key: str) -> bool:
    """Whether some value of the key (null is one) is in several rows."""
    return df.groupBy(key).count().filter("count > 1").limit(1).count() > 0


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as no column of df has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keyed(docs: DataFrame, *columns: str, key: str = "doc_id") -> DataFrame:
    """docs as (doc_id, sub, *columns): sub numbers the rows that share a doc_id, in order of their texts; 0 for all others.

    The numbering costs a shuffle only where some doc_id repeats.
    """
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), *columns)
    if not repeated(slim, "doc_id"):
        return slim.select("doc_id", F.lit(0).alias("sub"), *columns)
    order = Window.partitionBy("doc_id").orderBy(*columns)
    return slim.select("doc_id", (F.row_number().over(order) - 1).cast("int").alias("sub"), *columns)


def xxh64_long(x: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of a long column (XXH64 of its 8 bytes, seed 42), as unsigned numbers."""
    p1, p2, p3, p4, p5 = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rot = lambda v, n: (v << np.uint64(n)) | (v >> np.uint64(64 - n))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (rot(x.astype(np.int64).view(np.uint64) * p2, 31) * p1)
        h = rot(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


def bucket_of(doc: np.ndarray, n: int) -> np.ndarray:
    """A bucket for each doc_id, by Spark's own hash; null ids are given as the least long."""
    return (xxh64_long(doc) >> np.uint64(1)).astype(np.int64) % n


_held: dict = {}


def trim() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def held(key, make):
    """make() once for a key in this process. A worker serves one operator after the other: what another key held goes first."""
    if key not in _held:
        if _held:
            _held.clear()
            gc.enable()
            gc.collect()
            trim()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Drop what held() keeps; for operators that hold nothing from task to task."""
    held(None, lambda: None)


def tidy(f, keep: bool = True):
    """A function for mapInArrow that, when its task ends, leaves no memory in the worker but what held() keeps; without keep not even that.

    Workers live on, idle, beside the next stages, and count as the executor's memory there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            let_go()
        try:
            yield from f(batches)
        finally:
            trim()

    return run


def cut(batch: pa.RecordBatch, text: int, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """A batch in slices with about `size` bytes of text each, or one longer text."""
    _, offsets = text_bytes(batch.column(text))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


NULL_ID = -(1 << 63)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    head = ";".join(f"{a.dtype.str},{a.size}" for a in arrays).encode()
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    n = int.from_bytes(raw[:4], "little")
    at, out = 4 + n, []
    for part in raw[4:at].decode().split(";"):
        kind, size = part.split(",")
        out.append(np.frombuffer(raw, kind, int(size), at))
        at += out[-1].nbytes
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array and the offsets of each; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset :] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids_of(column: pa.Array) -> np.ndarray:
    """A column of doc_ids; null becomes NULL_ID."""
    return column.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)
