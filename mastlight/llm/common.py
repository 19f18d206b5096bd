"""What the operators share: batch slicing, byte-level word hashing, and the tables they read."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import mastlight
from mastlight.session import pin_utc

#: A slice handed to numpy holds about this many bytes of text (or one text, if that is longer).
SLICE_BYTES = 1 << 20
#: Rows in an Arrow batch: keeps a batch of long documents small.
BATCH_ROWS = 1000

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX1 = np.uint64(0xBF58476D1CE4E5B9)
MIX2 = np.uint64(0x94D049BB133111EB)


def prepare(spark: SparkSession) -> None:
    """Session settings of the llm queries: UTC, Arrow batches that stay small for long texts, the package on the workers."""
    pin_utc(spark)
    send_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def send_package(spark: SparkSession) -> None:
    """Send this package's code to the executors (once a context), as the workers import it."""
    context = spark.sparkContext
    if getattr(context, "_mastlight_sent", False):
        return
    package = Path(mastlight.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="mastlight-code-")) / "mastlight_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))  # served by the driver, so its own temporary folder will do
    context._mastlight_sent = True


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let_go() -> None:
    """Hand memory that a task has freed back to the system: its worker process lives on beside the next stage's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a work folder that one job has made and no other reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches so that each cut holds about ``limit`` bytes of text; NULL counts as empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        values = [b"" if v is None else v for v in column.to_pylist()]
        begin = held = 0
        for i, value in enumerate(values):
            if i > begin and held + len(value) > limit:
                yield batch.slice(begin, i - begin), values[begin:i]
                begin, held = i, 0
            held += len(value)
        if begin < len(values):
            yield batch.slice(begin), values[begin:]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX1
    x ^= x >> np.uint64(27)
    x *= MIX2
    x ^= x >> np.uint64(31)
    return x


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64, for texts up to n bytes."""
    inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
    return powers(n, ODD), powers(n, inverse)


def hashed_words(texts: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of many texts.

    ``is_word[byte]`` tells which bytes make up words.  Returns the hashes of all words in order, the
    first word of each text (one entry more than texts), and where each word starts and ends in its text.
    """
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(lengths + 1, out=begins[1:])
    inside = is_word[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[0::2], edges[1::2]
    size = 1 << max(20, int(len(data)).bit_length())
    up, down = _tables(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts])
    first = np.searchsorted(starts, begins)
    base = np.repeat(begins[:-1], np.diff(first))
    return words, first, starts - base, ends - base


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes of the given inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out
