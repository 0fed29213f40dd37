"""Shared helpers of the text operators: reading, bounded Arrow batches, words as hashed arrays.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. Words are found and hashed for a whole
batch at once; a batch is cut by bytes of text, so the memory of a task doesn't depend on the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.session import configure
from weftmill.sources.tables import read_table

# Bytes of text that Spark hands to Python at once, and that one step of a function works on. Small, since
# the workers of an executor share its memory with the JVM.
OWN_ARROW_BYTES = "4m"
SLICE_BYTES = 1 << 20
# Regular expression of the white space that splits words, as Spark and DuckDB read it.
BLANKS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES = np.random.Generator(np.random.PCG64(20261)).integers(1, 2**64, 256, dtype=np.uint64)
# Mask of the first n bytes of eight.
_HEADS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this package, where the session still has Spark's own."""
    configure(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) not in (OWN_ARROW_BYTES, spark.sparkContext.getConf().get(key)):
        spark.conf.set(key, OWN_ARROW_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), f"{sf_dir}/{name}.parquet")


def id_remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a null id, which so is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n)), F.lit(-1))


def with_fields(columns: list[T.StructField], more: str) -> T.StructType:
    """Schema of existing columns, whatever their names, and further ones as DDL."""
    return T.StructType([*columns, *T.StructType.fromDDL(more).fields])


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most `max_bytes` of text together (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(
    df: DataFrame,
    column: str,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | T.StructType,
    max_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """`df.mapInArrow` over slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, max_bytes):
                out = fn(part)
                if out is not None:
                    yield out
            # Workers stay for later tasks, also of other queries: give back what this batch took.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit keys evenly (splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """Words of the texts of one batch.

    `first[d] : first[d + 1]` are the words of text d; `starts` and `ends` are byte places in `data`.
    Null texts have no words. `lower` folds A-Z only; with `punctuation` every ASCII byte that is no
    letter or digit splits words as well, with `tails` a word also begins at one of these bytes if it
    follows an ASCII letter.
    """

    def __init__(self, texts: pa.Array, lower: bool = True, punctuation: bool = False, tails: bytes = b""):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        blob = pc.fill_null(texts.cast(pa.large_binary()), b"")
        _, places, data = blob.buffers()
        offsets = np.frombuffer(places, np.int64)[blob.offset : blob.offset + len(blob) + 1]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.data = _LOWER[raw] if lower else raw
        self.offsets = offsets
        word = ~(_PUNCTUATION if punctuation else _WHITE)[raw]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        inner = offsets[offsets < len(raw)]
        begins[inner] = word[inner]
        if tails:
            tail = np.isin(raw[1:], np.frombuffer(tails, np.uint8))
            begins[1:] |= tail & _LETTER[raw[:-1]]
        stops = word.copy()
        stops[:-1] &= ~word[1:] | begins[1:]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, the same on every machine and in every run."""
        n = len(self.data)
        up, down = _power_tables(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[self.data] * up[:n], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The number of one word for each different word, and for each word which of them it is.

        Words meet by hash and are compared byte by byte; if two that differ have one hash, the batch
        is grouped by the words themselves.
        """
        _, at, which = np.unique(self.hashes(), return_index=True, return_inverse=True)
        sizes = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        # The first eight bytes of each word as one number, then what longer words have besides.
        heads = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))[self.starts]
        heads &= _HEADS[np.minimum(sizes, 8)]
        same = np.array_equal(sizes, sizes[at][which]) and np.array_equal(heads, heads[at][which])
        long = np.flatnonzero(sizes > 8)
        if same and len(long):
            rest, begin = sizes[long] - 8, self.starts[long] + 8
            places = np.repeat(begin - (np.cumsum(rest) - rest), rest) + np.arange(rest.sum())
            away = np.repeat(self.starts[at][which[long]] - self.starts[long], rest)
            same = np.array_equal(self.data[places], self.data[places + away])
        if same:
            return at, which
        data, seen = self.data.tobytes(), {}
        which = np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip(self.starts.tolist(), self.ends.tolist())])
        return np.unique(which, return_index=True)[1], which
