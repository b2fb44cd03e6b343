"""What the training-data operators share: the folder all executors see, and vectorised text hashing."""

from __future__ import annotations

import ctypes
import os
import posixpath
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the query contracts: words end at these bytes.
WHITESPACE = b" \t\n\x0b\x0c\r"
#: The same as a regular expression over characters.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that the vectorised code looks at together; longer documents stand alone.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; only where that is unset (tests), under a local one."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: executors need a folder that all of them see")
        top = "file://" + tempfile.mkdtemp(prefix="lamina-")
        spark.conf.set("spark.checkpoint.dir", top)
    return posixpath.join(top, uuid.uuid4().hex)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int, read: bool = False) -> Iterator[None]:
    """Jobs started inside send at most so many rows at once to Python workers: whole texts are large, and JVM and worker both hold a batch.

    read: no more are decoded at once from Parquet either.
    """
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", *["spark.sql.parquet.columnarReaderBatchSize"] * read]
    before = {name: spark.conf.get(name) for name in names}
    for name, value in before.items():
        spark.conf.set(name, str(min(rows, int(value)) if int(value) > 0 else rows))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that gives freed memory back when it ends: its worker lives on, idle, beside those of later stages."""

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return all_of


def give_back() -> None:
    """Returns freed memory to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


_scope: ContextVar[Tables | None] = ContextVar("tables", default=None)


class Tables:
    """The working tables of an operator: those that its result does not read go when it ends."""

    def __init__(self) -> None:
        self.made: dict[str, SparkSession] = {}
        self.kept: dict[str, SparkSession] = {}

    def __enter__(self) -> Tables:
        self.outer = _scope.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _scope.reset(self.outer)
        outer = _scope.get()
        for path, spark in self.made.items():
            discard(spark, path)
        if outer is not None:  # what the result of a part reads is a working table of the whole
            outer.made |= self.kept

    def keep(self, df: DataFrame) -> DataFrame:
        """A table that the result reads."""
        self.kept[df.working_path] = self.made.pop(df.working_path)
        return df

    def drop(self, df: DataFrame) -> None:
        """A table that is no longer needed."""
        if (path := df.__dict__.get("working_path")) in self.made:
            discard(self.made.pop(path), path)


def discard(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Cuts lineage with a Parquet table in the shared folder, so a lost executor costs a re-read only. options: of the Parquet writer."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["working_path"] = path
    if (scope := _scope.get()) is not None:
        scope.made[path] = spark
    return out


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI or plain path, and the path in it."""
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    scheme, mark, rest = path.partition("://")
    return pafs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + mark + rest)


def put(path: str, parts: Iterator[bytes]) -> int:
    """Writes a file under a name of its own, then moves it to `path`; returns its bytes."""
    fs, at = store(path)
    fs.create_dir(os.path.dirname(at), recursive=True)
    own = f"{at}.{TaskContext.get().taskAttemptId() if TaskContext.get() else 0}.part"
    n = 0
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
            n += len(part)
    try:
        fs.move(own, at)
    except OSError:  # a store that does not replace files: an earlier run of this task has left the same one
        if fs.get_file_info(at).type != pafs.FileType.File:
            raise
        fs.delete_file(own)
    return n


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n."""
    return F.crc32(key.cast("string").cast("binary")) % n


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column without copying, and the offset of each row; null is empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


#: One random odd number for each byte value, and the base of the rolling polynomial with its inverse modulo 2**64.
BYTE = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1) modulo 2**64, by doubling."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(10, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        filled, step = 1, base
        while filled < size:
            have[filled : 2 * filled] = have[:filled] * np.uint64(step)
            filled, step = filled * 2, step * step % (1 << 64)
        _powers[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes start…end that does not depend on where they stand."""
    return mix((prefix[end] - prefix[start]) * powers(INVERSE, len(prefix))[start] + (end - start).astype(np.uint64))


#: The lowest 0 … 8 bytes of a number.
_low = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes of a word that are hashed by vectors; what is longer goes through blake2b.
SHORT = 64


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words start…end by their bytes: eight are mixed in at a time, so no pattern of bytes cancels out as in a polynomial."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    wide = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    size = end - start
    out = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    live, k = np.arange(len(size)), 0
    while len(live) and k < SHORT:
        part = wide[start[live] + k] & _low[np.minimum(size[live] - k, 8)]
        out[live] = mix((out[live] ^ part) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
        k += 8
        live = live[size[live] > k]
    for i in live.tolist():
        rest = np.frombuffer(blake2b(data[start[i] + k : end[i]].tobytes(), digest_size=8).digest(), np.uint64)
        out[i : i + 1] = mix((out[i : i + 1] ^ rest) * np.uint64(0x9E3779B97F4A7C15))
    return out


_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _lower[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray, separators: bytes = WHITESPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of words before each row (as offsets)."""
    inside = np.ones(256, bool)
    inside[np.frombuffer(separators, np.uint8)] = False
    mark = inside[data]
    first, last = mark.copy(), mark.copy()
    first[1:] &= ~mark[:-1]
    last[:-1] &= ~mark[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] = mark[edge]
    last[edge - 1] = mark[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def shingle_hashes(words: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows and their row; a row of fewer words, but not none, is one window."""
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    count = len(words) - n + 1
    out, rows = [], []
    if count > 0:
        h = words[:count]
        for k in range(1, n):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count])
        same = row[:count] == row[n - 1 :]
        out.append(h[same])
        rows.append(row[:count][same])
    length = np.diff(at)
    for size in range(1, n):
        short = np.flatnonzero(length == size)
        if len(short):
            h = words[at[short]] + np.uint64(size)
            for k in range(1, size):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[at[short] + k])
            out.append(mix(h + np.uint64(size)))
            rows.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(rows)
