"""Vector codes: each vector as four indexes into codebooks, found through memoised grid cells.

1. Rows whose vector is NULL or holds a NULL or non-finite component go. Components become integers floor(1024 * x), and all that
   follows is exact integer arithmetic, so results do not depend on the order or the spread of rows.
2. A vector is cut into `PARTS` equal parts. The codebook of a part starts as that part of the vectors of the `ENTRIES` smallest ids.
3. In each round a task assigns the parts of its vectors and adds them up by entry; only these sums are shuffled, and at most
   one row per entry and component comes to the driver: `ENTRIES` times the length of a vector, whatever the number of rows.
4. Assigning: a part lies in a cell of a coarse grid. For a cell that a task has not met, the least and the greatest distance from
   each entry to the cell's box are worked out. An entry whose least distance is above another's greatest can be nearest to no
   point of the box: it is dominated. The entries left are kept under the hash of the cell, and only they are evaluated
   exactly. A memo is emptied when it holds `CELLS` cells, so it is bounded; hashes are 128 bits wide.

The grid's width is a parameter; codes do not depend on it. Vectors are handled some thousands at a time, so memory is bounded
by a batch. The coded rows are written in the shared folder once, and sums of errors by label are joined to them; labels that
many rows share are added up in each task first.

Defined: the length of vectors is that of the kept vector of the smallest id; a vector of another length is kept with NULL
code and error and takes no part in the codebooks. A length that `PARTS` does not divide is an error. NULL ids come after all others;
rows of equal id go by their components. With fewer than `ENTRIES` vectors the codebooks are shorter; without any the result is
empty. Repeated rows each count. Components outside +-2^26 after scaling (|x| from 65,536 on) are evaluated in Python integers; an
error beyond a long is NULL, and so is its label's sum. NULL labels are one label; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.store import cut, free_name

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
CELL_WIDTH = 32
CELLS = 1 << 14
BATCH = 2048
SAFE = 1 << 26
LONG = (1 << 63) - 1
LIMB = 60


@dataclass(frozen=True)
class CodeOptions:
    vector: str = "embedding"
    key: str = "vec_id"
    label: str = "label"
    parts: int = PARTS
    entries: int = ENTRIES
    rounds: int = ROUNDS
    cell_width: int = CELL_WIDTH


def usable(vector: str):
    """True where the vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(1024 * x): 64-bit integers, or Python integers where any is outside the safe range."""
    values = np.asarray(values, np.float64)
    if not values.size or np.abs(values).max() < SAFE / SCALE:
        return np.floor(values * SCALE).astype(np.int64)
    whole = [Fraction(float(x)) * SCALE // 1 for x in values.ravel()]
    found = np.empty(len(whole), object)
    found[:] = [int(x) for x in whole]
    return found.reshape(values.shape)


class Coder:
    """Nearest entries of one part position, through a memo of grid cells. `book`: integers, one row each."""

    def __init__(self, book: np.ndarray, width: int = CELL_WIDTH):
        wide = np.array([any(not -SAFE <= x <= SAFE for x in entry) for entry in book], bool)
        self.book, self.width = book, width
        self.safe, self.wide = np.flatnonzero(~wide), np.flatnonzero(wide)
        self.entries = book[self.safe].astype(np.int64)
        self.memo: dict[bytes, np.ndarray] = {}
        self.evaluated = self.met = 0

    def _undominated(self, corner: np.ndarray) -> list[np.ndarray]:
        """For each box [corner, corner + width - 1]: the entries that may be nearest to a point of it, ascending.

        Distances are taken in doubled coordinates, in which a box has a whole middle and reaches `width` - 1 to both sides; they
        are added up component by component over all cells and entries, in 32 bits where all sums fit.
        """
        reach, found = self.width - 1, []
        middle, doubled = 2 * corner + reach, 2 * self.entries.T
        largest = int(np.abs(middle).max(initial=0)) + int(np.abs(doubled).max(initial=0)) + reach
        kind = np.int32 if largest**2 * corner.shape[1] < 1 << 31 else np.int64
        middle, doubled = middle.astype(kind), np.ascontiguousarray(doubled.astype(kind))
        for lo in range(0, len(corner), 256):
            cells = middle[lo : lo + 256]
            least = np.zeros((len(cells), len(self.entries)), kind)
            greatest = np.zeros_like(least)
            for k, entry in enumerate(doubled):
                gap = np.abs(cells[:, k, None] - entry)
                far = gap + kind(reach)
                greatest += far * far
                gap = np.maximum(gap - kind(reach), 0)
                least += gap * gap
            cell, entry = np.nonzero(least <= greatest.min(1)[:, None])
            found += np.split(entry, np.searchsorted(cell, np.arange(1, len(cells))))
        return found

    def _candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        keys = [hashlib.blake2b(c.tobytes(), digest_size=16).digest() for c in cells]
        new = [k for k, key in enumerate(keys) if key not in self.memo]
        self.met += len(cells) - len(new)
        if len(self.memo) + len(new) > CELLS:
            kept = {key: self.memo[key] for key in keys if key in self.memo}
            self.memo = kept
        for k, entries in zip(new, self._undominated(cells[new] * self.width)):
            self.memo[keys[k]] = entries
        return [self.memo[key] for key in keys]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point, the lower one of equals, and the squared distance."""
        if not points.shape[1]:
            return np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        if points.dtype == object or not len(self.safe):
            return self._against(points, range(len(self.book)))
        index, error = self._through_cells(points)
        index = self.safe[index]
        if len(self.wide):
            other, gap = self._against(points, self.wide)
            closer = (gap < error) | ((gap == error) & (other < index))
            index[closer], error[closer] = other[closer], gap[closer].astype(np.int64)
        return index, error

    def _through_cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        index, error = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        cells, where = np.unique(np.floor_divide(points, self.width), axis=0, return_inverse=True)
        where = where.reshape(-1)
        candidates = self._candidates(cells)
        count = np.array([len(c) for c in candidates], np.int64)
        starts = np.cumsum(count) - count
        listed = np.concatenate(candidates) if len(candidates) else np.zeros(0, np.int64)
        # A slice of points at a time, so that the pairs of a point and a candidate stay few.
        for lo in range(0, len(points), 256):
            cell = where[lo : lo + 256]
            n = count[cell]
            first = np.cumsum(n) - n
            inside = np.arange(n.sum()) - np.repeat(first, n)
            entry = listed[np.repeat(starts[cell], n) + inside]
            gap = self.entries[entry] - np.repeat(points[lo : lo + 256], n, axis=0)
            gap = np.einsum("ij,ij->i", gap, gap)
            least = np.minimum.reduceat(gap, first)
            hit = np.flatnonzero(gap == np.repeat(least, n))
            owner = np.repeat(np.arange(len(cell)), n)[hit]
            _, earliest = np.unique(owner, return_index=True)
            index[lo : lo + 256], error[lo : lo + 256] = entry[hit[earliest]], least
            self.evaluated += len(entry)
        return index, error

    def _against(self, points: np.ndarray, entries) -> tuple[np.ndarray, np.ndarray]:
        """The nearest of some entries, ascending, in Python integers, which have no range to leave."""
        points = points.astype(object)
        index, error = np.zeros(len(points), np.int64), None
        for entry in entries:
            gap = ((points - self.book[entry].astype(object)) ** 2).sum(1)
            if error is None:
                index[:], error = entry, gap
            else:
                closer = gap < error
                index[closer], error[closer] = entry, gap[closer]
        return index, error


def _vectors(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their scaled vectors): rows of the wanted length, those in the safe range first, then those outside it."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == length)
    if not len(rows):
        return
    flat = np.asarray(column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False), np.float64)
    flat = flat.reshape(len(rows), length)
    wide = (np.abs(flat) >= SAFE / SCALE).any(1) if length else np.zeros(len(rows), bool)
    for chosen in (~wide, wide):
        if chosen.any():
            yield rows[chosen], scaled(flat[chosen])


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, BATCH):
        yield batch.slice(lo, BATCH)


def _limbs(total: int) -> list[tuple[int, int]]:
    """The limbs of an integer, so that sums of any size are sums of decimals; the lowest one is always there."""
    sign, rest, found = (-1 if total < 0 else 1), abs(total), []
    while rest or not found:
        found.append((len(found), sign * (rest & ((1 << LIMB) - 1))))
        rest >>= LIMB
    return found


def _one_round(kept: DataFrame, books: list[np.ndarray], options: CodeOptions) -> list[np.ndarray]:
    """The codebooks after one round: entries that have parts become the floors of their means."""
    parts, width = options.parts, books[0].shape[1]
    length, vector = parts * width, options.vector

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [Coder(book, options.cell_width) for book in books]
        added: dict[tuple[int, int], list] = {}
        for batch in batches:
            for piece in _sliced(batch):
                for _, points in _vectors(piece.column(vector), length):
                    for part, coder in enumerate(coders):
                        own = points[:, part * width : (part + 1) * width]
                        index, _ = coder.nearest(own)
                        for entry in np.unique(index):
                            chosen = own[index == entry].astype(object if own.dtype == object else np.int64).sum(0)
                            row = added.setdefault((part, int(entry)), [[0] * width, 0])
                            row[0] = [a + int(b) for a, b in zip(row[0], chosen)]
                            row[1] += int((index == entry).sum())
        rows = [
            (part, entry, at, limb, value, n)
            for (part, entry), (totals, n) in sorted(added.items())
            for at, total in enumerate(totals)
            for limb, value in _limbs(total)
        ]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64()]
        arrays = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "at", "limb", "total", "n"])

    schema = "part int, entry int, at int, limb int, total decimal(38,0), n bigint"
    partial = kept.select(vector).mapInArrow(sums, schema)
    # One row per entry, component and limb at most: their number is fixed by the options and the length of a vector.
    added = partial.groupBy("part", "entry", "at", "limb").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    totals: dict[tuple[int, int, int], list[int]] = {}
    for r in added:
        row = totals.setdefault((r.part, r.entry, r["at"]), [0, 0])
        row[0] += int(r.total) << (LIMB * r.limb)
        row[1] = max(row[1], r.n)
    new = [[[int(x) for x in entry] for entry in book] for book in books]
    for (part, entry, at), (total, n) in totals.items():
        new[part][entry][at] = total // n
    return [_packed(book) for book in new]


def _packed(book: list[list[int]]) -> np.ndarray:
    """An integer array, of Python integers if any is outside the safe range."""
    safe = all(-SAFE <= x <= SAFE for entry in book for x in entry)
    return np.array(book, np.int64 if safe else object).reshape(len(book), -1)


def first_books(kept: DataFrame, options: CodeOptions) -> list[np.ndarray] | None:
    """The parts of the vectors of the smallest ids; None without any vector."""
    key, vector = F.col(options.key), F.col(options.vector)
    order = [key.asc_nulls_last(), vector.asc()]
    first = kept.select(key, vector).orderBy(*order).limit(1).collect()
    if not first:
        return None
    length = len(first[0][1])
    if length % options.parts:
        raise ValueError(f"{options.parts} parts do not divide vectors of length {length}")
    rows = kept.where(F.size(vector) == length).select(key, vector).orderBy(*order).limit(options.entries).collect()
    values = [[int(x) for x in scaled(np.array(r[1], np.float64).reshape(1, -1))[0]] for r in rows]
    width = length // options.parts
    return [_packed([v[p * width : (p + 1) * width] for v in values]) for p in range(options.parts)]


def trained(kept: DataFrame, options: CodeOptions) -> list[np.ndarray] | None:
    books = first_books(kept, options)
    if books is None or not books[0].shape[1]:
        return books
    for _ in range(options.rounds):
        books = _one_round(kept, books, options)
    return books


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def coded(kept: DataFrame, books: list[np.ndarray], options: CodeOptions, names: tuple[str, str] = ("code", "error")) -> DataFrame:
    """`kept` with the code and the summed squared distance of each vector."""
    parts, width = options.parts, books[0].shape[1]
    digits = max(2, len(f"{options.entries - 1:x}"))
    fields = StructType.fromDDL(f"`{names[0]}` string, `{names[1]}` bigint").fields
    schema = StructType([*kept.schema.fields, *fields])
    column = kept.columns.index(options.vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = [Coder(book, options.cell_width) for book in books]
        for batch in batches:
            for piece in _sliced(batch):
                codes: list[str | None] = [None] * piece.num_rows
                errors: list[int | None] = [None] * piece.num_rows
                for rows, points in _vectors(piece.column(column), parts * width):
                    found = [c.nearest(points[:, p * width : (p + 1) * width]) for p, c in enumerate(coders)]
                    indexes = np.stack([index for index, _ in found], 1).tolist()
                    total = sum(error.astype(object) for _, error in found)
                    for row, index, error in zip(rows.tolist(), indexes, total):
                        codes[row] = "".join(f"{i:0{digits}x}" for i in index)
                        errors[row] = error if error <= LONG else None
                added = [pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
                yield pa.RecordBatch.from_arrays([*piece.columns, *added], names=schema.fieldNames())

    return kept.mapInArrow(run, schema)


def compressed(df: DataFrame, options: CodeOptions = CodeOptions()) -> DataFrame:
    """`df`'s usable rows with code, error, label_error and codebooks_sha256; an earlier column of such a name goes."""
    made = ("code", "error", "label_error", "codebooks_sha256")
    kept = df.drop(*made).where(usable(options.vector))
    books = trained(kept, options)
    if books is None:
        return kept.selectExpr(
            "*", "CAST(NULL AS string) code", "CAST(NULL AS bigint) error", "CAST(NULL AS bigint) label_error",
            "CAST(NULL AS string) codebooks_sha256",
        )
    rows = cut(coded(kept, books, options), "vector-codes")
    same = free_name(df, "same_label")
    whole = F.try_sum(F.col("error").cast("decimal(38,0)"))
    sums = rows.groupBy(F.col(options.label).alias(same)).agg(
        # A vector of another length has no error and adds nothing; one whose error is too great leaves its label without a sum.
        F.when(~F.max(F.col("code").isNotNull() & F.col("error").isNull()), F.coalesce(whole, F.lit(0)).try_cast("bigint"))
        .alias("label_error")
    )
    joined = rows.join(sums, F.col(options.label).eqNullSafe(F.col(same))).drop(same)
    return joined.withColumn("codebooks_sha256", F.lit(books_sha256(books)))
