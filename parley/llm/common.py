"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Hashable, Iterator
from typing import Any
from uuid import uuid4

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.session import shared_dir

#: Rows of a fixed width (a hash, an id, a few numbers) that a broadcast may hold: some MB.
BROADCAST_ROWS = 200_000


#: Rows of text that go to Python at a time, and their bytes; the JVM and the worker both hold such a batch.
ARROW_ROWS, ARROW_BYTES = 2_000, 8 << 20

#: Spark's setting that removes the shuffle files of an action when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_RESIDENT: dict[Hashable, Any] = {}


def resident(key: Hashable, make: Callable[[], Any]) -> Any:
    """The one large object that a Python worker keeps from task to task; asking for another lets go of the last."""
    if key not in _RESIDENT:
        let_go()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def let_go() -> None:
    """Free what an earlier operator left in this worker, and hand unused memory back to the system: workers outlive
    stages, and what they once held would count against the executor for good."""
    import ctypes

    import pyarrow as pa

    _RESIDENT.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call and no need for it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of text of this session's Python stages."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write `df` as a table in the cluster's shared folder and read it back.

    Unlike a cached frame the table outlives lost executors.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action are removed as soon as it is done; for actions whose shuffles no other reads."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def stored_lean(df: DataFrame, name: str) -> DataFrame:
    """`stored`, and the shuffle files of the write are removed."""
    with shuffles_removed(df.sparkSession):
        return stored(df, name)


def removed(*tables: DataFrame) -> None:
    """Remove the files of stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bounded(narrow: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a stored frame of fixed-width rows for broadcast if it is small; else leave it to be shuffled."""
    return F.broadcast(narrow) if narrow.limit(rows + 1).count() <= rows else narrow


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def digest(column: Column) -> Column:
    """128-bit content hash in 16 bytes."""
    return F.unhex(F.md5(column))


def held_out(id_col: str, parts: int) -> Column:
    """Whether crc32 of the id's decimal text leaves 2; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == 2, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a finaliser in the manner of splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _placed(values: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """A hash of each value and its place in its run. Every value is mixed before a run's are added up: in a plain
    polynomial modulo 2**64 the powers of the base cancel out, and long words of few letters have one hash."""
    return mix((values.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + inside.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run values[start:end]; runs are in order, not empty, and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    picked = _placed(values[np.repeat(starts, lengths) + inside], inside)
    sums = np.add.reduceat(picked, np.cumsum(lengths) - lengths)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def tile_hashes(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """`run_hashes` of runs that cover all values, without copying them."""
    inside = np.arange(len(values), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    return mix(np.add.reduceat(_placed(values, inside), starts) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """`run_hashes` of runs of bytes with other values, eight bytes at a time: most words are shorter."""
    eights = np.ndarray(len(data) + 1, np.dtype("<u8"), np.concatenate([data, np.zeros(8, np.uint8)]).data, 0, (1,))
    lengths = ends - starts
    kept = np.array([(1 << 8 * left) - 1 for left in range(9)], np.uint64)
    out = mix((eights[starts] & kept[np.minimum(lengths, 8)]) + np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero(lengths > 8)
    if len(long):
        more = (lengths[long] - 1) >> 3
        inside = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
        at = np.repeat(starts[long], more) + 8 * inside
        value = eights[at] & kept[np.minimum(np.repeat(ends[long], more) - at, 8)]
        value = mix(mix(value + np.uint64(0x9E3779B97F4A7C15)) + inside.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        out[long] += np.add.reduceat(value, np.cumsum(more) - more)
    return mix(out + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each distinct key, and for every key the number of its kind."""
    import pandas as pd

    which, kinds = pd.factorize(keys)
    first = np.empty(len(kinds), np.int64)
    first[which[::-1]] = np.arange(len(keys) - 1, -1, -1)
    return first, which


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, .. for each range, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def utf8_batch(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of an Arrow string column, nulls as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0]:at[-1]] if len(at) else held[:0], at - at[0]


#: UTF-8 bytes between which words lie: space, tab, line feed, vertical tab, form feed, carriage return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def blank_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between blanks in joined texts, and the first word of each text."""
    inside = ~BLANK[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]  # a word never crosses from one text into the next
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, at)
