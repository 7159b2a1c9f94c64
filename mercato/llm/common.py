"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.sinks import scratch_path

# Words are runs of bytes outside this set: space, tab, LF, VT, FF, CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor sees, so a lost executor costs
    the tasks of one stage and no result depends on a single copy.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_BATCH = 2048
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(df: DataFrame) -> None:
    """Let at most ``ROWS_PER_BATCH`` rows come to a Python task at once, as the session may hold long texts."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_ROWS, "10000")) <= ROWS_PER_BATCH:
        conf.set(_BATCH_ROWS, str(ROWS_PER_BATCH))


def tokenizer_path(name: str) -> str:
    """A file of the installed public tokenizers, at the same place on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def word_count(text: Column | str) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(seed: int, *cols: Column | str) -> Column:
    """A number strictly inside (0, 1) that depends on the seed and the values only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 53))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and its row offsets (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task: Python workers live on and are used again."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def pieces(batches: Iterable[pa.RecordBatch], column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Split (never join) batches so that each holds about ``most`` bytes of ``column``.

    A text longer than that comes alone and whole.
    """
    for batch in batches:
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        i, n = 0, len(batch)
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
            j = min(max(j, i + 1), n)
            yield batch.slice(i, j - i)
            i = j
    release_memory()


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str], least: int = 4096) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``keys`` (at least ``least`` rows each, but for the last)."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        rows += len(batch)
        if rows < least:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        cut = _last_group_start(whole, keys)
        if cut:
            yield whole.slice(0, cut)
            rest = whole.slice(cut)
            held, rows = rest.to_batches(), len(rest)
        else:
            least = max(least, 2 * rows)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
    del held
    release_memory()


def _last_group_start(t: pa.Table, keys: list[str]) -> int:
    change = np.zeros(len(t), bool)
    for k in keys:
        v = t.column(k).to_numpy(zero_copy_only=False)
        change[1:] |= v[1:] != v[:-1]
    at = np.flatnonzero(change)
    return int(at[-1]) if len(at) else 0


def spread(total: int, per_part: int, most: int = 100_000) -> int:
    """A number of partitions so that each holds about ``per_part`` of ``total``."""
    return int(max(1, min(most, -(-total // per_part))))


_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (in a new array)."""
    x = x.astype(np.uint64, copy=True)
    for m in _MIX:
        x ^= x >> np.uint64(33)
        x *= np.uint64(m)
    x ^= x >> np.uint64(33)
    return x


class Rolling:
    """Hashes of substrings of one long array from prefix sums (mod 2**64).

    ``of(start, stop)`` is equal for equal contents wherever they start.
    """

    BASE = 0x9E3779B97F4A7C15 | 1
    KEPT = 1 << 22  # powers that a worker keeps; a longer array brings its own
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, values: np.ndarray, salt: int = 0):
        n = len(values)
        self.powers, self.inverse = Rolling._powers, Rolling._inverse
        if len(self.powers) <= n:
            size = max(n + 1, 1 << 16)
            self.powers = _geometric(Rolling.BASE, size)
            self.inverse = _geometric(pow(Rolling.BASE, -1, 1 << 64), size)
            if size <= Rolling.KEPT:
                Rolling._powers, Rolling._inverse = self.powers, self.inverse
        if values.dtype == np.uint8:
            lut = mix64(np.arange(256, dtype=np.uint64) + np.uint64(0x51 + salt * 1000))
            values = lut[values]
        elif values.dtype == np.uint32:  # code points
            values = _char_codes(salt)[values]
        else:
            values = mix64(values.astype(np.uint64) + np.uint64(0x51 + salt * 1000))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        x = self.sums[stop] - self.sums[start]
        x *= self.inverse[start]
        return mix64(x)

    def windows(self, width: int) -> np.ndarray:
        """The hash of every window of ``width`` values."""
        n = len(self.sums) - 1
        if n < width:
            return np.zeros(0, np.uint64)
        x = self.sums[width:] - self.sums[:n - width + 1]
        x *= self.inverse[:n - width + 1]
        return mix64(x)


@functools.cache
def _char_codes(salt: int) -> np.ndarray:
    return mix64(np.arange(0x110001, dtype=np.uint64) + np.uint64(0x51 + salt * 1000))


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def spans_to_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the given runs, run after run."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
