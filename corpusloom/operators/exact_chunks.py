"""Chunks under the limit of a real tokenizer, whose counts do not add up over joined texts.

Every decision is made on the count of the text as it would be joined, which the tokenizer is not asked for as a whole: a
tokenizer names places at which it splits any text, whatever stands around (between a letter and ` x`, say). Tokens between two
such places are counted once; joining two texts changes only the seam between the last place of the one and the first place of
the other, so only that is encoded again. Without such places all joined text is, with the same result.

Cutting into headings, blocks and sentences stays with column functions; Python workers get arrays of these and count.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions.markdown import starts_with_heading
from corpusloom.functions.text import let, runs
from corpusloom.operators.sections import (
    heading_blocks,
    merge_orphans,
    part_markers,
    part_text,
    sentences_of,
    split_heading,
)
from corpusloom.options import ChunkOptions

# Between two letters of words a blank starts a token in every tokenizer that splits at blanks first.
BETWEEN_WORDS = r"(?<=[A-Za-z]) (?=[A-Za-z])"


@dataclass(frozen=True)
class ExactTokenizer:
    """`count(text)`, and a pattern for the places where it splits any text: tokens before plus tokens from there on.

    `drops_blank` is for tokenizers that put a blank before every text themselves: a text that starts at a place is then
    counted without its own.
    """

    count: Callable[[str], int]
    places: str | None = None
    drops_blank: bool = False


@dataclass(frozen=True)
class _Unit:
    """A text up to its first place, the count from there to its last place, and what follows; `middle` is None without one."""

    head: str
    middle: int | None
    tail: str
    tail_count: int


@dataclass(frozen=True)
class _Group:
    """A joined text: the count up to its last place and the text from there on."""

    closed: int
    tail: str
    at_place: bool


class Counter:
    """Counts of joined texts; `encoded` is the number of characters given to the tokenizer."""

    def __init__(self, tokenizer: ExactTokenizer):
        self.tokenizer, self.encoded = tokenizer, 0
        self.places = re.compile(tokenizer.places) if tokenizer.places else None

    def count(self, text: str, at_place: bool = False) -> int:
        if at_place and self.tokenizer.drops_blank:
            text = text[1:]
        self.encoded += len(text)
        return self.tokenizer.count(text) if text else 0

    def unit(self, text: str) -> _Unit:
        first = self.places.search(text) if self.places else None
        if not first:
            return _Unit(text, None, text, 0)
        last = first.start()
        for found in self.places.finditer(text, last):
            last = found.start()
        middle, tail = text[first.start() : last], text[last:]
        return _Unit(text[: first.start()], self.count(middle, True), tail, self.count(tail, True))

    def opened(self, unit: _Unit) -> tuple[int, _Group]:
        return self.grown(_Group(0, "", False), "", unit)

    def grown(self, group: _Group, sep: str, unit: _Unit) -> tuple[int, _Group]:
        """The count of the group's text, `sep` and the unit, and the group they make."""
        seam = group.tail + sep + unit.head
        if unit.middle is None:
            return group.closed + self.count(seam, group.at_place), _Group(group.closed, seam, group.at_place)
        closed = group.closed + self.count(seam, group.at_place) + unit.middle
        return closed + unit.tail_count, _Group(closed, unit.tail, True)

    def total(self, text: str) -> int:
        return self.opened(self.unit(text))[0]

    def marks(self, units: list[tuple[str, str, bool]], limit: int) -> list[bool]:
        """Whether each of the units (text, separator before it, opens anyway) opens a group of at most `limit` tokens."""
        found, group = [], None
        for text, sep, opens in units:
            unit = self.unit(text)
            if group is not None and not opens:
                total, joined = self.grown(group, sep, unit)
                if total <= limit:
                    found.append(False)
                    group = joined
                    continue
            found.append(True)
            group = self.opened(unit)[1]
        return found

    def halves(self, text: str, limit: int) -> list[str]:
        """A text above the limit cut at the last blank of its first half, else in the middle, until the pieces fit."""
        if len(text) < 2 or self.total(text) <= limit:
            return [text]
        middle = len(text) // 2
        at = text.rfind(" ", 0, middle) + 1 or middle
        return self.halves(text[:at], limit) + self.halves(text[at:], limit)

    def bodies(self, blocks: list[str], sentences: list[list[str]], limit: int) -> list[str]:
        units: list[tuple[str, str, bool]] = []
        for block, parts in zip(blocks, sentences):
            if self.total(block) <= limit:
                units.append((block, "\n\n", False))
                continue
            for k, sentence in enumerate(parts):
                pieces = self.halves(sentence, limit)
                units += [(piece, "\n", k == 0 or j > 0) for j, piece in enumerate(pieces)]
        joined: list[str] = []
        for (text, sep, _), opens in zip(units, self.marks(units, limit)):
            if opens:
                joined.append(text)
            else:
                joined[-1] += sep + text
        return joined

    def parts(
        self, heading: str, title: str, blocks: list[str], sentences: list[list[str]], options: ChunkOptions
    ) -> list[str]:
        """Bodies such that no part, heading and markers included, is above the limit, if its frame leaves room for that."""
        limit = max(options.max_tokens - self.total(title) - options.heading_reserve, 1)
        while True:
            found = self.bodies(blocks, sentences, limit)
            n = len(found)
            over = max(self.total(part_text(heading, body, k, n)) for k, body in enumerate(found)) - options.max_tokens
            if over <= 0 or limit == 1:
                return found
            limit = max(limit - over, 1)


Load = Callable[[], ExactTokenizer]


def _counted(df: DataFrame, load: Load, added: str, make: Callable[[Counter, pa.RecordBatch], pa.Array]) -> DataFrame:
    """`df` with a column `added` (name and type) that `make(counter, batch)` gives; a worker loads the tokenizer once a task."""
    schema = StructType([*df.schema.fields, *StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(load())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, make(counter, batch)], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def recombine_exact(rows: DataFrame, column: str, load: Load, options: ChunkOptions = ChunkOptions()) -> DataFrame:
    """`rows` whose array of chunks is joined to sections: a chunk without a heading goes to the section before it
    while their joined text has at most `max_tokens`. Columns `_opens` and `_marks` are helpers."""
    limit = options.max_tokens

    def marks(counter: Counter, batch: pa.RecordBatch) -> pa.Array:
        found = [
            None if texts is None else counter.marks([(t, "\n\n", bool(o)) for t, o in zip(texts, opens)], limit)
            for texts, opens in zip(batch[column].to_pylist(), batch["_opens"].to_pylist())
        ]
        return pa.array(found, pa.list_(pa.bool_()))

    opens = F.transform(column, lambda c: starts_with_heading(c))
    marked = _counted(rows.withColumn("_opens", opens), load, "_marks array<boolean>", marks)
    joined = runs(F.col(column), lambda _, i: F.get(F.col("_marks"), i), "\n\n")
    return marked.withColumn(column, joined).drop("_opens", "_marks")


def exact_chunks(rows: DataFrame, column: str, load: Load, options: ChunkOptions = ChunkOptions()) -> DataFrame:
    """One row per chunk for an array of cut chunks: `section_no` and `part_no` (from 1) and `text` in place of the array.

    Recombined, orphan headings merged, and what is above the limit split at blocks, sentences and, where a sentence is above
    it, blanks. Orphans are merged by words, as their limit is one of words. A chunk that is only a heading stays; so does
    a heading that leaves no room under the limit. NULL arrays give no rows.
    """

    def count(counter: Counter, batch: pa.RecordBatch) -> pa.Array:
        return pa.array([counter.total(text) if text else 0 for text in batch["_chunk"].to_pylist()], pa.int64())

    def bodies(counter: Counter, batch: pa.RecordBatch) -> pa.Array:
        found = [
            None if cut is None or not cut["blocks"] else counter.parts(*cut.values(), options)
            for cut in batch["_cut"].to_pylist()
        ]
        return pa.array(found, pa.list_(pa.string()))

    def cut(h: Column) -> Column:
        names = (h["heading"].alias("heading"), h["title"].alias("title"))
        return let(
            heading_blocks(h),
            lambda b: F.struct(*names, b.alias("blocks"), F.transform(b, lambda x: sentences_of(x)).alias("sentences")),
        )

    own = [c for c in rows.columns if c != column]
    sections = recombine_exact(rows, column, load, options)
    merged = F.when(F.col(column).isNotNull(), merge_orphans(F.col(column), options))
    chunks = sections.select(*own, F.posexplode(merged).alias("_section", "_chunk"))
    counted = _counted(chunks, load, "_count bigint", count)
    over = F.col("_count") > options.max_tokens
    headed = counted.withColumn("_cut", F.when(over, let(split_heading(F.col("_chunk")), cut)))
    packed = _counted(headed, load, "_bodies array<string>", bodies)
    parts = F.when(F.col("_bodies").isNull(), F.array("_chunk")).otherwise(
        part_markers(F.col("_bodies"), F.col("_cut.heading"))
    )
    found = packed.select(*own, (F.col("_section") + 1).alias("section_no"), F.posexplode(parts).alias("_part", "text"))
    return found.select(*own, "section_no", (F.col("_part") + 1).alias("part_no"), "text")


def numbered_chunks(chunks: DataFrame) -> DataFrame:
    """The rows of `exact_chunks` with `chunk_no`, counted from 1 in each document, in place of section and part.

    Rows of a document follow each other in one partition, so one pass counts them and nothing is shuffled.
    """
    own = [f for f in chunks.schema.fields if f.name not in ("section_no", "part_no", "text")]
    schema = StructType([*own, *StructType.fromDDL("chunk_no int, text string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            numbers = []
            for section, part in zip(batch["section_no"].to_pylist(), batch["part_no"].to_pylist()):
                number = 1 if (section, part) == (1, 1) else number + 1
                numbers.append(number)
            columns = [*(batch[f.name] for f in own), pa.array(numbers, pa.int32()), batch["text"]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return chunks.mapInArrow(run, schema)
