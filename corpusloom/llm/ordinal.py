"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are 0 (toxic), 1 (not toxic, of low quality) and 2 (not toxic, of good quality). A text has the hashed set of its
distinct lower-cased words (A-Z), its distinct runs of marks, and three cells for its shape: the tenth its share of
marks, of capitals and of distinct words falls in. One weight per cell is shared by all grades, and ordered thresholds cut the
score: P(grade <= k) = logistic(threshold_k - score). That gives the expected grade and the tail probabilities.

The model is fitted on at most `max_rows` labelled documents, the first by a hash of their id, over their whole
texts, in one task of bounded size (mini-batches, adaptive steps, a lasso penalty; cells of fewer than `least_docs` of these
documents stay 0, so that no document is learnt by its own rare words). Its table of 2^`bits` weights is broadcast and every
document is scored in one pass, without a shuffle.

Defined cases: NULL and empty texts have no cells; they get the grade probabilities of the bare thresholds. Labels with a NULL are not used;
of several labels of one id the worst counts. Without labels the model is all zeros with thresholds -1 and 1. Other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.blocks import (
    LETTERS_AND_DIGITS, LOWER, NOT_BLANK, Words, append_columns, mix, row_ranges, stream, text_bytes, words_of,
)

GRADES = 3
MARKS = NOT_BLANK & ~LETTERS_AND_DIGITS


@dataclass(frozen=True)
class OrdinalOptions:
    bits: int = 20
    max_rows: int = 12_000
    epochs: int = 30
    batch: int = 64
    step: float = 0.3
    lasso: float = 2e-3
    least_docs: int = 5
    seed: int = 0
    least_tail: float = 0.5


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, one column each."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _tenths(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.ceil(10 * part / np.maximum(whole, 1)).astype(np.uint64)


def _block_cells(words: Words, marks: Words, raw: np.ndarray, bits: int) -> np.ndarray:
    """Distinct (row, cell) of a block as row * 2^bits + cell. `words` are lower-cased letters and digits, `raw` is not."""
    shift, row = np.uint64(64 - bits), np.uint64(bits)
    keys = [np.unique(w.doc.astype(np.uint64) << row | w.hashes >> shift) for w in (words, marks)]
    distinct = np.bincount((keys[0] >> row).astype(np.int64), minlength=words.rows)
    n_words, n_bytes = np.diff(words.first), np.diff(words.at)
    filled = np.flatnonzero(n_words + np.diff(marks.first))
    capital = np.concatenate([[0], np.cumsum((raw >= 0x41) & (raw <= 0x5A))])[words.at]
    mark_bytes = np.bincount(marks.doc, marks.end - marks.start, minlength=words.rows)
    shapes = (_tenths(mark_bytes, n_bytes), _tenths(np.diff(capital), n_bytes), _tenths(distinct, n_words))
    for salt, tenth in zip(stream(11, len(shapes)), shapes, strict=True):
        keys.append(filled.astype(np.uint64) << row | mix(tenth[filled] + salt) >> shift)
    return np.unique(np.concatenate(keys))


def _cells(column: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of each text, and the row of each, by row."""
    cells, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    data, at = text_bytes(column)
    for lo, hi in row_ranges(at):
        raw, inside = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        words = words_of(raw, inside, LETTERS_AND_DIGITS, lower=True)
        keys = _block_cells(words, words_of(LOWER[raw], inside, MARKS), raw, bits)
        cells.append((keys & np.uint64((1 << bits) - 1)).astype(np.int64))
        rows.append((keys >> np.uint64(bits)).astype(np.int64) + lo)
    return np.concatenate(cells), np.concatenate(rows)


def fit(cells: np.ndarray, rows: np.ndarray, grades: np.ndarray, options: OrdinalOptions) -> OrdinalModel:
    """Fit on texts given as distinct cells by row (see `_cells`) and a grade per row."""
    weights = np.zeros(1 << options.bits)
    squares = np.full(1 << options.bits, 1e-8)
    # Thresholds are first, first + exp(gap), ...: in order whatever the steps.
    free = np.array([-1.0] + [np.log(2.0)] * (GRADES - 2))
    free_squares = np.full(GRADES - 1, 1e-8)
    n = len(grades)
    shared = np.bincount(cells, minlength=len(weights)) >= options.least_docs
    cells, rows = cells[shared[cells]], rows[shared[cells]]
    at = np.searchsorted(rows, np.arange(n + 1))
    order = np.random.default_rng(options.seed)
    for _ in range(options.epochs if n else 0):
        for batch in np.array_split(order.permutation(n), max(1, n // options.batch)):
            pick = np.concatenate([np.arange(at[r], at[r + 1]) for r in batch])
            which = np.repeat(np.arange(len(batch)), at[batch + 1] - at[batch])
            cell = cells[pick]
            score = np.bincount(which, weights[cell], minlength=len(batch))
            gaps = np.exp(free[1:])
            thresholds = np.concatenate([free[:1], free[0] + np.cumsum(gaps)])
            bounds = np.concatenate([[-np.inf], thresholds, [np.inf]])
            grade = grades[batch]
            high, low = _logistic(bounds[grade + 1] - score), _logistic(bounds[grade] - score)
            share = np.maximum(high - low, 1e-12)
            d_high, d_low = high * (1 - high) / share, low * (1 - low) / share
            slope = (d_high - d_low) / len(batch)  # of the loss, by score
            touched, back = np.unique(cell, return_inverse=True)
            step = np.bincount(back, slope[which])
            squares[touched] += step**2
            rate = options.step / np.sqrt(squares[touched])
            moved = weights[touched] - rate * step
            weights[touched] = np.sign(moved) * np.maximum(np.abs(moved) - rate * options.lasso, 0)
            by_threshold = np.zeros(GRADES + 1)
            np.add.at(by_threshold, grade + 1, -d_high / len(batch))
            np.add.at(by_threshold, grade, d_low / len(batch))
            inner = by_threshold[1:GRADES]
            after = np.cumsum(inner[::-1])[::-1]
            step = np.concatenate([after[:1], after[1:] * gaps])
            free_squares += step**2
            free -= 0.1 * options.step * step / np.sqrt(free_squares)
    return OrdinalModel(weights, np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))]))


def _rated(df: DataFrame, labels: DataFrame, doc_id: str, text: str, options: OrdinalOptions) -> DataFrame:
    """text, grade of the labelled documents to fit on."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    chosen = (
        labels.dropna(subset=[doc_id, "quality", "toxic"])
        .groupBy(F.col(doc_id).alias("_rated"))
        .agg(F.min(grade).alias("grade"))
        .orderBy(F.xxhash64("_rated"), "_rated")
        .limit(options.max_rows)
    )
    # At most max_rows rows of two numbers: a proven bound for the broadcast.
    return df.join(F.broadcast(chosen), F.col(doc_id) == F.col("_rated")).select(F.col(text).alias("text"), "grade", "_rated")


def train(
    df: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", options: OrdinalOptions = OrdinalOptions()
) -> OrdinalModel:
    """The model; what reaches the driver is its table of weights."""

    def one_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, rows, grades, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            cell, row = batch["cells"].values.to_numpy(), np.diff(batch["cells"].offsets.to_numpy())
            cells.append(cell)
            rows.append(np.repeat(np.arange(batch.num_rows), row) + n)
            grades.append(batch["grade"].to_numpy().astype(np.int64))
            n += batch.num_rows
        model = fit(*(np.concatenate(x) for x in (cells, rows, grades)), options)
        used = np.flatnonzero(model.weights)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([used.astype(np.int64).tobytes()]),
                pa.array([model.weights[used].tobytes()]),
                pa.array([model.thresholds.tobytes()]),
            ],
            names=["cells", "weights", "thresholds"],
        )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, rows = _cells(batch["text"], options.bits)
            offsets = np.searchsorted(rows, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["_rated"], batch["grade"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells))],
                names=["id", "grade", "cells"],
            )

    rated = _rated(df, labels, doc_id, text, options).mapInArrow(features, "id bigint, grade int, cells array<bigint>")
    fitted = (
        rated.repartition(1).sortWithinPartitions("id", "grade", "cells")
        .mapInArrow(one_task, "cells binary, weights binary, thresholds binary").first()
    )
    if fitted is None:  # no labelled document
        return fit(*[np.zeros(0, np.int64)] * 3, options)
    weights = np.zeros(1 << options.bits)
    weights[np.frombuffer(fitted["cells"], np.int64)] = np.frombuffer(fitted["weights"])
    return OrdinalModel(weights, np.frombuffer(fitted["thresholds"]))


def graded(df: DataFrame, model: OrdinalModel, text: str = "text", options: OrdinalOptions = OrdinalOptions()) -> DataFrame:
    """`df` with `_expected_grade`, `_p_ge_1`, `_p_ge_2` and `_kept`, true if the last is high enough."""
    sent = df.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds))

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        weights, thresholds = sent.value
        cells, rows = _cells(batch[text], options.bits)
        n = batch.num_rows
        score = np.bincount(rows, weights[cells], minlength=n)
        tails = OrdinalModel(weights, thresholds).tails(score)
        return [pa.array(tails.sum(axis=1)), *(pa.array(tails[:, k]) for k in range(GRADES - 1))]

    names = ", ".join(f"_p_ge_{k} double" for k in range(1, GRADES))
    return append_columns(df, f"_expected_grade double, {names}", make).withColumn(
        "_kept", F.col(f"_p_ge_{GRADES - 1}") >= options.least_tail
    )
