"""Token counts of whole texts with a SentencePiece model, and of huge texts in overlapping chunks.

A place between two characters is *proven stable* if the vocabulary has no piece that holds the two next
to each other: no merge can ever join them, so the tokens of both sides do not depend on each other.

- Texts of up to `chunk_chars` characters are cut before single-space runs where that is proven stable;
  equal units are encoded once per worker. Texts that hold the space mark itself are encoded whole.
- Longer texts are cut into chunks that overlap. Chunks are spread over the cluster and encoded with
  offsets. In an overlap both encodings must have a common token boundary that is proven stable; there
  they are spliced. Texts with an overlap that has none are cut again with wider overlaps and chunks,
  until all align; a text that fits one chunk always does. Copies of a long text are encoded once.

Defined cases: NULL counts as empty, 0 tokens. Results depend on the text alone, so repeated rows, ties and NULL
ids need no rule. Other columns pass through unread; their order and names stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.blocks import Words, append_columns, row_ranges, text_bytes
from corpusloom.llm.store import cut

MARK = "▁"
_CACHED_UNITS = 1_000_000


@dataclass(frozen=True)
class TokenOptions:
    model: str = public_tokenizers.path("piece_bpe_32k.model")
    limit: int = 4096
    chunk_chars: int = 32_768
    overlap_chars: int = 256


class Counter:
    """A loaded model with what is proven about its vocabulary."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        self.joined = set()
        for piece in (self.model.id_to_piece(i) for i in range(self.model.get_piece_size())):
            self.joined.update(zip(piece, piece[1:], strict=False))
        ends_before_space = all(left == MARK or right != MARK for left, right in self.joined)
        prefixed = self.model.encode("a b", out_type=str)[:1] == self.model.encode("b a", out_type=str)[1:]
        spaces_kept = "".join(self.model.encode("a   b", out_type=str)).count(MARK) == 4
        self.cuts_at_spaces = ends_before_space and prefixed and spaces_kept
        self.units: dict[bytes, int] = {b"": self.count([" "])[0] - 1 or 1}

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)] if texts else []

    def stable(self, left: str, right: str) -> bool:
        return (left.replace(" ", MARK), right.replace(" ", MARK)) not in self.joined


@cache
def counter(model: str) -> Counter:
    return Counter(model)


def _unit_counts(found: Counter, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Tokens of each row of a block; `data` has no space mark of its own."""
    if not len(data):
        return np.zeros(len(at) - 1, np.int64)
    space = data == 0x20
    space_before = np.concatenate([[True], space[:-1]])
    cuts = space & ~space_before
    filled = at[:-1][np.diff(at) > 0]
    cuts[filled] = False
    opens = np.flatnonzero(cuts)
    start = np.sort(np.concatenate([opens, filled]))
    end = np.append(start[1:], len(data))
    start = start + cuts[start]  # the space of a cut stands for the mark that the model puts before a text
    units = Words(data, at, start, end)
    row = np.searchsorted(at, end - 1, side="right") - 1
    full = end > start
    counts = np.full(len(start), found.units[b""])
    if full.any():
        hashes = Words(data, at, start[full], end[full]).hashes
        _, index, which = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        lo, hi = units.start[full][index], units.end[full][index]
        contents = [raw[s:e] for s, e in zip(lo.tolist(), hi.tolist(), strict=True)]
        known = found.units
        missing = [c for c in contents if c not in known]
        if len(known) + len(missing) > _CACHED_UNITS:
            empty = known[b""]
            known.clear()
            known[b""] = empty
            missing = contents
        known.update(zip(missing, found.count([m.decode() for m in missing]), strict=True))
        counts[full] = np.array([known[c] for c in contents])[which]
    return np.bincount(row, counts, minlength=len(at) - 1).astype(np.int64)


def text_counts(column: pa.Array, model: str) -> np.ndarray:
    """Tokens of each text of a column."""
    found = counter(model)
    data, at = text_bytes(column)
    counts = np.zeros(len(at) - 1, np.int64)
    mark = np.frombuffer(MARK.encode(), np.uint8)
    for lo, hi in row_ranges(at):
        block, inside = data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        marks = np.flatnonzero(block == mark[0])
        marked = any(block[i : i + 3].tobytes() == mark.tobytes() for i in marks.tolist())
        if found.cuts_at_spaces and not marked:
            counts[lo:hi] = _unit_counts(found, block, inside)
        else:
            raw = block.tobytes()
            counts[lo:hi] = found.count([raw[s:e].decode() for s, e in zip(inside, inside[1:], strict=False)])
    return counts


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """texts: key, text. Overlapping chunks with their offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"].to_pylist(), strict=True):
                begins = list(range(0, max(len(text) - overlap, 1), chunk))
                for lo in range(0, len(begins), 64):
                    some = begins[lo : lo + 64]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key.as_py()] * len(some), pa.string()),
                            pa.array(some, pa.int64()),
                            pa.array([text[b : b + chunk + overlap] for b in some]),
                        ],
                        names=["key", "begin", "text"],
                    )

    return texts.mapInArrow(run, "key string, begin bigint, text string")


def _encoded(chunks: DataFrame, model: str, chunk: int, overlap: int) -> DataFrame:
    """Per chunk its number of tokens and the stable token boundaries of both overlaps: offset and tokens before it."""

    def edges(found: Counter, text: str, begin: int) -> tuple[int, list, list]:
        offsets = found.model.encode(text, return_type="offset_mapping")["offsets"]
        head, tail = [(0, 0)] if begin == 0 else [], []
        last = 0
        for number, (at, _) in enumerate(offsets):
            if last < at < len(text) and (at <= overlap or at >= chunk) and found.stable(text[at - 1], text[at]):
                if at <= overlap and begin:
                    head.append((begin + at, number))
                if at >= chunk:
                    tail.append((begin + at, number))
            last = at
        return len(offsets), head, tail

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = counter(model)
        for batch in batches:
            begins = batch["begin"].to_pylist()
            rows = [edges(found, t, b) for t, b in zip(batch["text"].to_pylist(), begins, strict=True)]
            sides = [
                pa.array([[p[k] for p in row[side]] for row in rows], pa.list_(pa.int64()))
                for side in (1, 2)
                for k in (0, 1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["begin"], pa.array([r[0] for r in rows], pa.int64()), *sides],
                names=["key", "begin", "n", "head", "head_n", "tail", "tail_n"],
            )

    lists = ", ".join(f"{name} array<bigint>" for name in ("head", "head_n", "tail", "tail_n"))
    return chunks.mapInArrow(run, f"key string, begin bigint, n bigint, {lists}")


def _spliced(encoded: DataFrame) -> DataFrame:
    """Tokens of each text: of every chunk, those between the boundaries shared with its neighbours. NULL if one has none."""
    by = Window.partitionBy("key").orderBy("begin")
    joint = F.array_min(F.array_intersect("tail", F.lead("head").over(by)))
    cuts = encoded.withColumn("last", F.lead("begin").over(by).isNull()).withColumn("to", joint)
    cuts = cuts.withColumn("from", F.when(F.col("begin") == 0, 0).otherwise(F.lag("to").over(by)))

    def tokens_at(side: str, at: str):
        return F.try_element_at(F.col(f"{side}_n"), F.array_position(side, F.col(at)).cast("int"))

    upto = F.when(F.col("last"), F.col("n")).when(F.col("to").isNotNull(), tokens_at("tail", "to"))
    after = F.when(F.col("from").isNotNull(), tokens_at("head", "from"))
    own = cuts.select("key", (upto - after).alias("own"))
    aligned = F.count("own") == F.count(F.lit(1))
    return own.groupBy("key").agg(F.when(aligned, F.sum("own")).alias("n_tokens"))


def _long_counts(texts: DataFrame, options: TokenOptions) -> DataFrame:
    """texts: key, text, one row per key. Key and tokens, overlaps widened until every text aligns."""
    chunk, overlap, left, done = options.chunk_chars, options.overlap_chars, texts, None
    while True:
        chunks = _chunks(left, chunk, overlap).repartition("key", "begin")
        counts = cut(_spliced(_encoded(chunks, options.model, chunk, overlap)), "long-counts")
        known = counts.filter("n_tokens is not null")
        done = known if done is None else done.unionByName(known)
        open_keys = counts.filter("n_tokens is null").select("key")
        if open_keys.isEmpty():
            return done
        left = left.join(open_keys, "key", "left_semi")
        chunk, overlap = 4 * chunk, 8 * overlap


def token_counts(df: DataFrame, text: str = "text", options: TokenOptions = TokenOptions()) -> DataFrame:
    """`df` with `_n_bytes`, `_n_tokens` and `_over_limit`."""
    if not 0 < 2 * options.overlap_chars <= options.chunk_chars:
        raise ValueError("overlap_chars must be above 0 and at most half of chunk_chars")
    model, given = options.model, F.col(text)
    # Byte lengths decide which path a text takes; both give the same counts.
    long_text = F.coalesce(F.octet_length(given) > options.chunk_chars, F.lit(False))
    short = append_columns(
        df.filter(~long_text), "_n_tokens bigint", lambda batch: [pa.array(text_counts(batch[text], model))]
    )
    long_rows = df.filter(long_text).withColumn("_key", F.sha2(given, 256))
    texts = long_rows.groupBy(F.col("_key").alias("key")).agg(F.first(given).alias("text"))
    counts = _long_counts(texts, options).select(F.col("key").alias("_text_key"), F.col("n_tokens").alias("_n_tokens"))
    joined = long_rows.join(counts, F.col("_key") == F.col("_text_key")).drop("_key", "_text_key")
    return (
        short.unionByName(joined)
        .withColumn("_n_bytes", F.coalesce(F.octet_length(given), F.lit(0)).cast("bigint"))
        .withColumn("_over_limit", F.col("_n_tokens") > options.limit)
    )
