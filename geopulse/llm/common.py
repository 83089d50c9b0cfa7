"""Helpers shared by the training-data operators.

Texts reach Python as Arrow batches.  :func:`utf8` gives the bytes of a string
column as one numpy array, and :func:`row_slices` walks it in slices of bounded
size, so a task's memory depends on the slice limit and on its longest text,
never on the number of rows.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geopulse.session import scratch_dir

SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: While a table is written: shuffle files go with the job, and Python gets small batches of rows (texts can be long).
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


@contextlib.contextmanager
def settings(conf, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for the time of a job; they are put back."""
    before = {k: conf.get(k) for k in values}
    try:
        for k, v in values.items():
            conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            conf.set(k, v)


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: cuts the lineage.

    The shuffle files of the job go as soon as the table is there, so an operator's
    disk is that of its largest step, not the sum of all.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with settings(spark.conf, _WRITING):
        df.write.partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that no later step reads."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def quoted(name: str) -> str:
    """A column name as :func:`F.col` takes it, whatever is in it."""
    return "`" + name.replace("`", "``") + "`"


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(column: str, modulus: int):
    """crc32 of a column as text, modulo ``modulus`` (null: as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the row boundaries in them (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes, one row at least."""
    start, rows = 0, len(bounds) - 1
    while start < rows:
        stop = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, boundaries) for each slice of the batches' text column."""
    release_memory()
    try:
        for batch in batches:
            data, bounds = utf8(batch.column(batch.schema.get_field_index(column)))
            for i, j in row_slices(bounds, limit):
                yield batch.slice(i, j - i), data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i]
    finally:
        release_memory()


#: What to call so that an operator drops what it remembers from task to task.
FORGET: list[Callable[[], None]] = []


def release_memory() -> None:
    """At a task's ends: a Python worker is used again, and what it keeps adds to the next stage's memory."""
    _powers.cache_clear()
    for forget in FORGET:
        forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, with :func:`release_memory` at the task's ends, when its own variables are gone."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        try:
            yield from run(batches)
        finally:
            release_memory()

    return whole


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(np.array([seed], np.uint64)))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct numbers and the count of each (by a sort: np.unique is many times slower)."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.append(at, len(keys)))


@functools.lru_cache(maxsize=4)
def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    base = int(seeds(1, seed)[0]) | 1
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


class SpanHash:
    """64-bit hashes of any byte spans of ``data``, from one running sum."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        size = 1 << max(12, (len(data) - 1).bit_length())
        power, self._inverse = _powers(size, seed)
        self._sum = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(seeds(256, seed + 7)[data] * power[:len(data)], out=self._sum[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end)."""
        return mix((self._sum[end] - self._sum[start]) * self._inverse[start])


def word_spans(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of bytes marked in ``is_word`` (256 flags).

    A run ends at a row boundary too.
    """
    inside = is_word[data]
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = bounds[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        before[edges] = False
        after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(bounds, start, "right") - 1
    return start, end, row


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans of a word's size, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))  # the eight bytes from each position
    size = end - start
    out, at = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), np.arange(len(start))
    for k in range(0, int(size.max(initial=0)), 8):
        if k:
            at = at[size[at] > k]
        left = np.minimum(size[at] - k, 8).astype(np.uint64)
        part = eight[start[at] + k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        out[at] = mix(out[at] * np.uint64(0xD6E8FEB86659FD93) + part)
    return out


#: A-Z become a-z, every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
