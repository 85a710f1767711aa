"""Shared pieces: cutting lineage in the cluster's shared folder, and vectorised views of Arrow text columns."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
LONG = 64
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK, _WRITERS = threading.Lock(), {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A folder of this run in the one that the cluster names in spark.checkpoint.dir. Where none is named, a temporary one
    serves a master that is local to this machine (tests); on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="terrazzo-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found}/terrazzo-{spark.sparkContext.applicationId}"


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the table that replaces them is written; the setting returns with the last writer."""
    with _LOCK:
        if not _WRITERS:
            _WRITERS["was"] = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        _WRITERS["n"] = _WRITERS.get("n", 0) + 1
    try:
        yield
    finally:
        with _LOCK:
            _WRITERS["n"] -= 1
            if not _WRITERS["n"]:
                spark.conf.set(CLEANUP, _WRITERS["was"])
                _WRITERS.clear()


def stash(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Cuts lineage: df as a Parquet table in the shared folder, which outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffle_cleanup(spark):
        df.write.options(**{"compression": "zstd"} | (options or {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stashed = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def drop(*stashed: DataFrame) -> None:
    """Deletes stashed tables that nothing reads any more."""
    for df in stashed:
        _delete(df.sparkSession, df.stashed)


def clean(spark: SparkSession) -> None:
    """Deletes all tables that this run has stashed, once its results are written."""
    _delete(spark, shared_dir(spark))


def give_back() -> None:
    """At the end of a task: what it has freed goes back to the system, as the worker lives on beside other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, count=n + 1, offset=8 * column.offset)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may own bytes
        valid = ~np.asarray(column.is_null().to_numpy(zero_copy_only=False))
        sizes = np.where(valid, np.diff(offsets), 0)
        if sizes.sum() != offsets[-1] - offsets[0]:
            data = np.concatenate([data[a:b] for a, b, ok in zip(offsets, offsets[1:], valid, strict=False) if ok] or [data[:0]])
            offsets = np.concatenate([[0], np.cumsum(sizes)])
    return data, offsets


def blocks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each; a longer row stands alone and whole."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def spaced(data: np.ndarray, offsets: np.ndarray, a: int, b: int, gap: int = 0x20) -> tuple[np.ndarray, np.ndarray]:
    """Rows a..b laid out with one gap byte before each and after the last, and where each row starts."""
    lo, hi = int(offsets[a]), int(offsets[b])
    starts = offsets[a:b] - lo + np.arange(1, b - a + 1)
    out = np.full(hi - lo + b - a + 1, gap, np.uint8)
    keep = np.ones(len(out), bool)
    keep[0] = keep[-1] = False
    keep[starts[1:] - 1] = False
    out[keep] = data[lo:hi]
    return out, starts


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of buf[start:end], all at once: eight bytes a step are mixed into the state of the spans that have them;
    what goes beyond LONG bytes is condensed by a cryptographic hash first."""
    size = ends - starts
    h = mix(size.astype(np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed))
    if not len(starts):
        return h
    room = np.zeros(len(buf) + 16 & ~7, np.uint8)
    room[: len(buf)] = buf
    at = np.empty(len(room) - 8, np.uint64)  # the eight bytes from each place on
    for k in range(8):
        at[k::8] = room[k : k + len(room) - 8].view(np.uint64)
    live, j = np.arange(len(starts)), 0
    while len(live):
        rest = size[live] - j
        word = at[starts[live] + j]
        word &= U64(2**64 - 1) >> (U64(8) * (8 - np.minimum(rest, 8)).astype(np.uint64))
        word[rest <= 0] = 0
        h[live] = mix((h[live] ^ word) * U64(0xD6E8FEB86659FD93) + U64(j))
        j += 8
        live = live[rest > 8]
        if j >= LONG:
            for i in live.tolist():
                tail = hashlib.blake2b(buf[starts[i] + j : ends[i]].tobytes(), digest_size=8, key=seed.to_bytes(8, "little")).digest()
                h[i : i + 1] = mix(h[i : i + 1] ^ U64(int.from_bytes(tail, "little")))
            break
    return h


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def word_spans(buf: np.ndarray, starts: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a spaced buffer, and for each row (and the end) the number of words before it."""
    inside = is_word[buf]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, last = edges[::2], edges[1::2]
    return first, last, np.append(np.searchsorted(first, starts), len(first))
