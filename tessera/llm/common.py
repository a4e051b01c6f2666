"""What the operators share: intermediate tables and Arrow text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.sources.commit import shared_path

BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch in this session: by rows alone, ten thousand long texts
    would be one batch.  A smaller bound that is set already stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the cluster shares (``spark.checkpoint.dir``); see ``shared_path``."""
    return shared_path(spark, f"tessera-{name}")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and
    later reads survive the loss of any executor.  Returns the table and its path.

    Shuffle files of the write go when it has ended; nothing reads them any more."""
    spark = df.sparkSession
    path, before = work_path(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete staged tables that nothing reads any more."""
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without a copy; a null is an empty text."""
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``most`` symbols; a longer row is a block alone."""
    lo, size = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > lo and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(lengths):
        yield lo, len(lengths)


def word_bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of flagged bytes; none crosses an offset."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(inside), bool)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty(len(inside), bool)
    after[-1:], after[:-1] = False, inside[1:]
    return np.flatnonzero(inside & (~before | edge[:-1])), np.flatnonzero(inside & (~after | edge[1:])) + 1


def prefix_sums(values: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values times rising powers, and the falling powers that bring a difference to its place."""
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, kept as long as the longest block."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.ones(1, np.uint64)

    def _grown(self, table: np.ndarray, base: int, n: int) -> np.ndarray:
        while len(table) < n:
            table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
        return table

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            self._up, self._down = self._grown(self._up, self.base, n), self._grown(self._down, self.inverse, n)
        return self._up[:n], self._down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_array(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-cased bytes as a binary array, and the row of each; ``is_word`` flags byte values."""
    inside = is_word[data]
    starts, ends = word_bounds(inside, offsets)
    places = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=places[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data[inside])])
    return words, np.searchsorted(offsets, starts, "right") - 1
