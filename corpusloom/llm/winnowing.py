"""Benchmark decontamination by winnowing.

Texts are runs of lower-cased words. Of the `gram`-word hashes in every window of `window` words the
smallest is kept as a fingerprint (the rightmost of equal ones), on both sides. So any window that a
document shares with a benchmark item brings the same fingerprint at the same place in both, and
joining fingerprints finds every shared window. A joined fingerprint is extended to the windows around it, each known by a
128-bit digest of its words, and a window is a hit if an item has it.

1. Benchmark fingerprints, and the digests of all windows of the benchmark with their items, are written as small tables.
2. Document fingerprints, about two in seven words, semi-join the distinct benchmark fingerprints.
   Spark broadcasts that side if its table is below the session's limit and shuffles and splits skew otherwise.
3. The places that are left, grouped by document, meet the texts again (the same choice by size). The windows around them, at
   most `window - gram + 1` a place, semi-join the distinct digests: a run of words that very many documents and items
   have in common gives a row per document and window, not one for each pair.
4. Hits are grouped by document to ranges of words; items join the distinct (document, digest) rows only then.

An item with fewer words than a window, but not none, is one window of its own; documents then also
give the hashes of all runs of that length.

Defined cases: NULL or empty texts have no words; such items never occur. Items with a NULL id are not
reported, and their windows do count as hits. Rows are told apart by a hash of id and text: rows that
equal each other get equal results, rows of one id with other texts their own. Other columns pass through unread.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.blocks import LETTERS_AND_DIGITS, Words, append_columns, blocks, covered
from corpusloom.llm.store import cut, free_name

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_PRINT = "key bigint, at int, need int, print bigint"


def winnowed(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a block and the index of the first word of each: the smallest gram of every window."""
    hashes, start = words.ngrams(gram)
    reach = window - gram + 1
    count = len(hashes) - reach + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    least, where = hashes[:count].copy(), np.arange(count)
    for step in range(1, reach):
        smaller = hashes[step : step + count] <= least
        least[smaller] = hashes[step : step + count][smaller]
        where[smaller] = np.flatnonzero(smaller) + step
    inside = start[reach - 1 :] == start[:count] + reach - 1
    chosen = np.unique(where[inside])
    return hashes[chosen], start[chosen]


def _prints(words: Words, window: int, gram: int, short) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The length of the windows that fingerprints stand for, their hashes and first words; a short run is its own."""
    return [(window, *winnowed(words, window, gram)), *((n, *words.ngrams(n)) for n in short)]


def _digest(words: list[bytes]) -> bytes:
    return blake2b(b" ".join(words), digest_size=16).digest()


def _item_words(words: Words, row: int) -> list[bytes]:
    own = slice(words.first[row], words.first[row + 1])
    return [words.data[s:e].tobytes() for s, e in zip(words.start[own], words.end[own])]


def _item_prints(items: DataFrame, window: int, gram: int) -> DataFrame:
    """items: item, text. Every fingerprint with the length of the windows it stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, words in blocks(batch["text"], LETTERS_AND_DIGITS, lower=True):
                n = np.diff(words.first)
                for need, hashes, start in _prints(words, window, gram, sorted(set(n[(n > 0) & (n < window)].tolist()))):
                    own = (n[words.doc[start]] == need) | (need == window)
                    needs = np.full(int(own.sum()), need, np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[own].view(np.int64)), pa.array(needs)], names=["print", "need"]
                    )

    return items.mapInArrow(run, "print bigint, need int").distinct()


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """items: item, text. The digest of every window and its item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch["item"].to_pylist()
            for lo, hi, words in blocks(batch["text"], LETTERS_AND_DIGITS, lower=True):
                found = []
                for row in range(hi - lo):
                    own = _item_words(words, row)
                    size = min(window, len(own))
                    found += [(_digest(own[k : k + size]), names[lo + row]) for k in range(len(own) - size + 1) if size]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.string())],
                    names=["digest", "item"],
                )

    return items.mapInArrow(run, "digest binary, item string").distinct()


def _doc_prints(docs: DataFrame, window: int, gram: int, short: tuple[int, ...]) -> DataFrame:
    """docs: key, text. All fingerprints of all documents: key, word position, length of their windows, hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_numpy()
            for lo, hi, words in blocks(batch["text"], LETTERS_AND_DIGITS, lower=True):
                for need, hashes, start in _prints(words, window, gram, short):
                    doc = words.doc[start]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[lo:hi][doc]),
                            pa.array((start - words.first[doc]).astype(np.int32)),
                            pa.array(np.full(len(start), need, np.int32)),
                            pa.array(hashes.view(np.int64)),
                        ],
                        names=["key", "at", "need", "print"],
                    )

    return docs.mapInArrow(run, _PRINT)


def _around(n: int, at: int, need: int, window: int, gram: int) -> range:
    """First words of the windows of `need` words, in a text of `n`, that hold the fingerprint at `at`."""
    if need < window:
        return range(at, at + 1)
    return range(max(0, at - (window - gram)), min(at, n - window) + 1)


def _doc_windows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """docs: key, text, places(at, need). The digests of the windows around the places of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_pylist()
            for row, places in enumerate(batch["places"].to_pylist()):
                words = _WORD.findall(batch["text"][row].as_py().encode().lower())
                found = {(k, p["need"]) for p in places for k in _around(len(words), p["at"], p["need"], window, gram)}
                ordered = sorted(found)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[row]] * len(ordered), pa.int64()),
                        pa.array([k for k, _ in ordered], pa.int32()),
                        pa.array([need for _, need in ordered], pa.int32()),
                        pa.array([_digest(words[k : k + need]) for k, need in ordered], pa.binary()),
                    ],
                    names=["key", "start", "need", "digest"],
                )

    return docs.mapInArrow(run, "key bigint, start int, need int, digest binary")


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    gram: int = 5,
) -> DataFrame:
    """`df` with `_n_words`, `_n_hit` and `_items`, the sorted ids (as strings) of the items that occur; earlier columns of
    these names go."""
    if not 1 <= gram <= window:
        raise ValueError("gram must be between 1 and window")
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text"))
    prints = cut(_item_prints(items, window, gram), "item-prints")
    windows = cut(_item_windows(items, window), "item-windows")
    sizes = prints.filter(F.col("need") < window).select("need").distinct()
    short = tuple(sorted(r[0] for r in sizes.collect()))  # at most window - 1 numbers

    df = df.drop("_n_words", "_n_hit", "_items")
    key = F.xxhash64(F.col(doc_id), F.col(text))
    docs = df.select(key.alias("key"), F.col(text).alias("text"))
    matched = _doc_prints(docs, window, gram, short).join(prints, ["print", "need"], "left_semi")
    places = cut(matched.groupBy("key").agg(F.collect_set(F.struct("at", "need")).alias("places")), "places")
    around = _doc_windows(docs.join(places, "key"), window, gram).distinct()
    hits = cut(around.join(windows.select("digest").distinct(), "digest", "left_semi"), "hits")
    owners = hits.select("key", "digest").distinct().join(windows.filter("item is not null"), "digest")
    names = owners.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = hits.groupBy("key").agg(F.collect_set(F.struct("start", "need")).alias("ranges")).join(names, "key", "left")

    own = {name: free_name(df, f"hit_{name}") for name in ("key", "of", "ranges", "items")}
    found = found.select(*[F.col(n).alias(own[m]) for n, m in (("key", "of"), ("ranges", "ranges"), ("items", "items"))])

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        n_words = [np.diff(words.first) for _, _, words in blocks(batch[text], LETTERS_AND_DIGITS, lower=True)]
        n_words = np.concatenate(n_words or [np.zeros(0)]).astype(np.int64)
        n_hit = np.zeros(batch.num_rows, np.int64)
        ranges = batch[own["ranges"]]
        for row in np.flatnonzero(ranges.is_valid().to_numpy(zero_copy_only=False)).tolist():
            hit = ranges[row].as_py()
            starts, lengths = (np.array([h[n] for h in hit], np.int64) for n in ("start", "need"))
            n_hit[row] = covered(starts, lengths, int(n_words[row])).sum()
        found = [names or [] for names in batch[own["items"]].to_pylist()]
        return [pa.array(n_words), pa.array(n_hit), pa.array(found, pa.list_(pa.string()))]

    # The hint keeps one plan at every size.
    found = cut(found, "found").hint("merge")
    joined = df.withColumn(own["key"], key).join(found, F.col(own["key"]) == F.col(own["of"]), "left")
    measured = append_columns(joined, "_n_words bigint, _n_hit bigint, _items array<string>", make)
    return measured.drop(*own.values())


def uncontaminated(df: DataFrame, benchmark: DataFrame, **named) -> DataFrame:
    """The rows of `df` without a shared window, with its own columns."""
    return contamination(df, benchmark, **named).filter("_n_hit = 0").select(*df.columns)
