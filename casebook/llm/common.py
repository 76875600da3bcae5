"""Small helpers the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: One word of the contracts: a run of anything but ASCII white space. ``bytes.split()`` cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts handed to numpy at once, so that a batch of very long texts doesn't multiply in memory.
SLICE_BYTES = 4 << 20
#: Input after which a task hands freed memory back; it does so at its end too, as workers live on between tasks.
TRIM_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files of steps whose results are already written.

    The cleaner acts when the driver's JVM finds a step's plan unused, which first takes Python to let go of it; a
    driver with memory to spare may not look for hours, while the files fill the executors' disks.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def give_back() -> None:
    """Hands what Python and Arrow have freed in this process back to the system; else a driver keeps the size of its largest step."""
    gc.collect()
    trim()


def trim() -> None:
    """``give_back`` for workers: what hangs in cycles stays."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc do so by themselves or not at all
        ctypes.CDLL(None).malloc_trim(0)


def word_count(text: Column | str) -> Column:
    """Number of words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``fn`` over the record batches of each task; it may return one batch or yield several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            if batch.num_rows:
                seen += batch.nbytes
                out = fn(batch)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out
            if seen >= TRIM_BYTES:
                batch = out = None
                trim()
                seen = 0
        batch = out = None
        trim()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``column`` holds about ``most`` bytes; a longer value stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """The values as UTF-8 bytes, a null as empty."""
    as_binary = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    return [v or b"" for v in as_binary.to_pylist()]


def flat_bytes(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All values back to back, and their n + 1 offsets."""
    offsets = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return np.frombuffer(b"".join(values), np.uint8), offsets


def flat_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values back to back, and their n + 1 offsets; a null as empty. Nothing is copied value by value."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = pc.fill_null(column, b"").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, 8 * column.offset)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_values(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary value for each stretch of ``flat``; they may overlap."""
    ends = np.zeros(sizes.size + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    if ends[-1] >= 1 << 31:
        raise ValueError("more than 2 GB in a batch")
    data = flat[np.arange(ends[-1]) + np.repeat(starts - ends[:-1], sizes)]
    return pa.Array.from_buffers(pa.binary(), sizes.size, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each 64-bit value (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ascending(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; for numbers a plain sort takes a fifth of the time of ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if values.size else values


class Remembered(dict):
    """word -> what was found for it, for the words seen of late.

    A Python worker goes from step to step and lives on, so only one such memory in it holds words: the first new word of
    another makes it forget.
    """

    most = 300_000
    holder: Remembered | None = None

    def put(self, word, value):
        if Remembered.holder is not self:
            if Remembered.holder is not None:
                Remembered.holder.clear()
                trim()
            Remembered.holder = self
        elif len(self) >= self.most:
            self.clear()
        self[word] = value
        return value


class WordHashes(Remembered):
    """64-bit hash of a word."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        return self.put(word, xxhash.xxh3_64_intdigest(word))

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


@functools.cache
def word_hashes() -> WordHashes:
    """One memory of word hashes for each Python worker."""
    return WordHashes()


def ranked_within(df: DataFrame, group: list[str], order: list[str], chunk: Column, size: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``size`` over the rows before this one in its group.

    ``chunk`` cuts each group into ranges that follow ``order``; only one chunk is ever sorted in one task, and only
    the totals of the chunks are added up per group, so a group may hold any share of the rows.
    """
    from pyspark.sql import Window

    cut = df.withColumn("_chunk", chunk).withColumn("_size", size)
    in_order = Window.partitionBy(*group, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy(*group, "_chunk").agg(F.sum("_size").alias("_total"))
    before = totals.select(
        *[F.col(g).alias(f"_g{n}") for n, g in enumerate(group)],
        F.col("_chunk").alias("_c"),
        F.coalesce(F.sum("_total").over(Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    same = F.col("_chunk").eqNullSafe(F.col("_c"))
    for n, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{n}"))
    return (
        cut.withColumn("_own", F.coalesce(F.sum("_size").over(in_order), F.lit(0)))
        .join(before, same)
        .withColumn(name, F.col("_own") + F.col("_before"))
        .select(*df.columns, name)
    )
