"""Shared helpers of the text operators: Arrow slices, vectorised word hashing, scratch tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cumulus.session import scratch_path, ship_package

# Text handled at once by the vectorised code of one task. Bounds its memory:
# a slice holds this many bytes or one single text, whichever is more.
SLICE_BYTES = 1 << 19

BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` (or one row): by rows alone a batch of long texts has no bound.

    A smaller setting of the session stays. Called before any work of the text
    operators, so the package goes to the Python workers here too.
    """
    ship_package(spark)
    given = spark.conf.get(BATCH_BYTES_CONF).lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(given[-1:], 0)
    if int(given.rstrip("kmg")) << unit > BATCH_BYTES:
        spark.conf.set(BATCH_BYTES_CONF, str(BATCH_BYTES))


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (cuts lineage)."""
    path = scratch_path(df.sparkSession, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files behind a table made by ``scratch_table`` once nothing reads it any more."""
    spark: SparkSession = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def row_slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` (string or binary) holds at most ``limit`` bytes."""
    col = batch.column(column)
    if len(col) == 0:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    ends = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1]
    start = 0
    while start < len(col):
        stop = int(np.searchsorted(ends, int(ends[start]) + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(col))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in col.cast(pa.binary()).to_pylist()]


def joined(texts: list[bytes], sep: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each followed by ``sep``, and the start of each (one more at the end)."""
    buf = np.frombuffer(sep.join([*texts, b""]), np.uint8)
    lengths = np.fromiter((len(t) + len(sep) for t in texts), np.int64, len(texts))
    return buf, np.concatenate(([0], np.cumsum(lengths)))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[0::2], edge[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) applied element-wise."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD1342543DE82EF95)
    return x ^ (x >> np.uint64(32))


_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


@lru_cache(maxsize=4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of the base and of its inverse, modulo 2**64."""
    step, back = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    with np.errstate(over="ignore"):
        up = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, step))))
        down = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, back))))
    return up, down


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    values[65:91] = values[97:123]  # A-Z count as a-z
    return values


class SpanHasher:
    """64-bit hashes of any byte spans of one buffer, ASCII letters in lower case.

    A running sum of byte value times a power of an odd base makes the hash of
    a span a difference times a negative power: equal bytes give equal hashes
    wherever they stand.
    """

    def __init__(self, buf: np.ndarray):
        size = 1 << max(16, int(len(buf)).bit_length())
        up, self.down = powers(size)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_byte_values()[buf] * up[: len(buf)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw + (end - start).astype(np.uint64))


@lru_cache(maxsize=1)
def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, *range(9, 14)]] = True
    return table


def space_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a byte buffer."""
    return runs(~_space()[buf])
