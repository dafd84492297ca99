"""Words and word n-grams of Arrow text columns as numpy arrays.

A text column is taken in blocks of rows of a few MB. Words are byte ranges of the UTF-8 data, so
nothing is decoded and no Python object is made for a word. NULL texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql.types import StructType

BLOCK_BYTES = 2 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: a bijection that changes about half of all bits for any change."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + (np.uint64(seed) << np.uint64(32))) * GOLDEN)


def _table(is_word) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)])


NOT_BLANK = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
LETTERS_AND_DIGITS = _table(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A)
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)

_BYTE_VALUES = stream(1, 256)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 64)
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE))])
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 data of a string column and the n + 1 row offsets into it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


@dataclass
class Words:
    """Words of a block of rows: `start`/`end` into `data`, `doc` the row of each word."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.at) - 1

    @cached_property
    def first(self) -> np.ndarray:
        """Index of the first word of each row, and the number of words at the end."""
        return np.searchsorted(self.start, self.at)

    @cached_property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    @cached_property
    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        total = np.cumsum(length)
        inside = np.arange(total[-1]) - np.repeat(total - length, length)
        values = _BYTE_VALUES[self.data[np.repeat(self.start, length) + inside]]
        values *= _power_table(int(length.max()))[inside]
        return mix(np.add.reduceat(values, total - length) + length.astype(np.uint64) * GOLDEN)

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `n` words of one row, and the index of the first word of each."""
        count = len(self.start) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        odd = stream(100 + n, n) | np.uint64(1)
        found = np.zeros(count, np.uint64)
        for j in range(n):
            found += self.hashes[j : j + count] * odd[j]
        within = np.flatnonzero(self.doc[:count] == self.doc[n - 1 :])
        return mix(found[within]), within


def words_of(data: np.ndarray, at: np.ndarray, table: np.ndarray = NOT_BLANK, lower: bool = False) -> Words:
    if lower:
        data = LOWER[data]
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    start = np.flatnonzero(after & (~before | edge))
    end = np.flatnonzero(before & (~after | edge))
    return Words(data, at, start, end)


def row_ranges(at: np.ndarray, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `block_bytes`; one row at least, so a long text is a block."""
    lo, rows = 0, len(at) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + block_bytes, side="right")) - 1)
        yield lo, hi
        lo = hi


def blocks(
    column: pa.Array, table: np.ndarray = NOT_BLANK, lower: bool = False, block_bytes: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) for each block of a text column."""
    data, at = text_bytes(column)
    for lo, hi in row_ranges(at, block_bytes):
        yield lo, hi, words_of(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], table, lower)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """True for each of `n` positions inside any of the ranges."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + lengths, n), -1)
    return np.cumsum(steps[:n]) > 0


def append_columns(df, schema: str, make):
    """`df` with columns added batch by batch: `make(batch)` gives one Arrow array per added column."""
    added = StructType.fromDDL(schema)
    names = [*df.columns, *added.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *make(batch)], names=names)

    return df.mapInArrow(run, StructType([*df.schema.fields, *added.fields]))
