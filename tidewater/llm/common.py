"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tidewater.session import scratch_path

#: Distinct parts of words that one Python worker remembers before it starts afresh.
CACHE_WORDS = 600_000
#: Bytes of an Arrow batch between the JVM and a Python worker.
ARROW_BYTES = 2 << 20
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_U = np.uint64
try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library; nothing is trimmed then
    _LIBC = None


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of a few MB in this session, so that long texts do not add up
    in a task's memory (rows are counted by default up to 64 MB)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def finished(spark: SparkSession) -> None:
    """After a step of many jobs: a collection on the driver, upon which Spark drops the
    shuffle files and broadcasts of plans that are gone, and its heap stays small."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again, so that
    later steps neither recompute it nor depend on the executors that made it."""
    bounded_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(batch: pa.RecordBatch) -> list[bytes]:
    """The batch's texts as UTF-8 bytes; NULL is empty. On bytes, ``split()`` cuts
    at space and the controls 9 to 13 only, ``lower()`` lowers A-Z only."""
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def terms(text: bytes) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    text = text.lower() if text.isascii() else text.decode("utf-8", "replace").lower().encode()
    return text.translate(None, _PUNCTUATION).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(_U)


def release_memory() -> None:
    """Gives freed memory back to the machine: a worker process waits for its next
    task with what the last one left it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def released(run: Callable) -> Callable:
    """``run`` over a task's Arrow batches, then ``release_memory``."""
    def go(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()
    return go


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64 output bits."""
    h = h ^ _U(salt)
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    """Hash of each run of ``k`` words in order (of the whole sequence when it
    is shorter; none without words)."""
    return run_hashes(word_hashes(words), min(k, len(words)))


def run_hashes(w: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes."""
    if not k or len(w) < k:
        return np.empty(0, dtype=_U)
    h = np.zeros(len(w) - k + 1, dtype=_U)
    for i in range(k):
        h = h * _U(0x9E3779B97F4A7C15) + w[i:len(w) - k + 1 + i]
    return mix(h, k)


def text_batches(batches: Iterator[pa.RecordBatch], chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about ``chars`` bytes of its
    ``text`` column at most (one row at least)."""
    for b in batches:
        size = b.column(b.schema.get_field_index("text")).get_total_buffer_size()
        step = max(1, int(b.num_rows * chars / max(size, 1)))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


class Powers:
    """Powers of a multiplier and of its inverse, as far as the longest text so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.cumprod(np.append(_U(1), np.full(2 * n, self.base, _U)), dtype=_U)
            self.down = np.cumprod(np.append(_U(1), np.full(2 * n, self.inverse, _U)), dtype=_U)
        return self.up[:n], self.down[:n]
