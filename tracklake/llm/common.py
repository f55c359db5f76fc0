"""Shared helpers of the corpus operators: shared-folder tables, Arrow text access, byte-level words.

A word is a run of bytes other than 0x20 and 0x09-0x0D. All these separators are ASCII, so words are
found on the UTF-8 bytes with numpy; no text is decoded for that.
"""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass works on; longer single texts are passed whole.
SLICE_BYTES = 2 << 20
NO_ID = -(1 << 63)  # stands for a null doc_id inside an operator


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where none is set and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir names no shared folder")
        found = tempfile.mkdtemp(prefix="tracklake-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, *by: str) -> DataFrame:
    """Writes df as a table in the shared folder, in a folder for each value of `by`, and reads it back: its lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    out.cut_path = path
    return out


def discard(df: DataFrame, within: str = "") -> None:
    """Removes a table that `cut` wrote, or a folder of it, once nothing reads it any more."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{df.cut_path}/{within}".rstrip("/"))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame, name: str = "row") -> DataFrame:
    """docs with a key of each row in the column `name`, the same however often docs is read.

    Rows of Parquet files are told by their file (a 64-bit hash of its path) and their place in it. Other rows are written
    with a key first.
    """
    try:
        return docs.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")).alias(name))
    except AnalysisException:  # not read from files
        return cut(docs.withColumn(name, F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place"))))


@functools.cache
def _malloc_trim():
    try:
        return ctypes.CDLL(None).malloc_trim  # of the GNU C library
    except (AttributeError, OSError):
        return lambda _: 0


def trim() -> None:
    """Gives memory that is free inside this worker back to the system, so that workers that wait hold little."""
    pa.default_memory_pool().release_unused()
    _malloc_trim()(0)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def has_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def internal_id(column: str = "doc_id"):
    """A null id becomes NO_ID, so that it joins and sorts like a value."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def external_id(column):
    return F.when(column != F.lit(NO_ID), column)


def byte_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string or binary array (null: empty) and its n + 1 offsets from 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about `most` bytes each, one row at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = b


def text_slices(texts: pa.Array, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of a string column of about `most` bytes each, one row at least."""
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    yield from slices(at, most)


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_R = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the number of its first word (n + 1 values)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SEPARATOR[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < n)]
    begin[edge] = inside[edge]
    stop = np.zeros(n + 1, bool)
    stop[1:n] = inside[:-1] & ~inside[1:]
    stop[n] = inside[-1]
    stop[edge] = inside[edge - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop)
    return starts, ends, np.searchsorted(starts, offsets, "left")


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of 64 over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _R), ("down", pow(_R, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
        if n > 4 * SLICE_BYTES:  # one very long text: don't hold its tables for ever
            return _POWERS.pop("up"), _POWERS.pop("down")
    return _POWERS["up"], _POWERS["down"]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans get equal hashes wherever they stand."""
    up, down = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    span = (total[ends] - total[starts]) * down[starts]
    return mix(span + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def hash_runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of `length` neighbours in a row of hashes (fewer values by length - 1)."""
    n = max(0, len(hashes) - length + 1)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = mix(out * np.uint64(_R) + hashes[k : k + n] + np.uint64(k + 1))
    return out


def concat_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one range after the other."""
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    if not len(lengths):
        return np.zeros(0, np.int64)
    steps = np.ones(int(lengths.sum()), np.int64)
    steps[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    steps[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(steps)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
