"""Oversized texts packed as rows, for texts whose units do not fit into one array.

`sections.split_oversized` holds all blocks of a chunk in one row. Here each block or sentence is a row, and one pass walks the
sorted rows of a partition with a running count and the part that is open as its only state, so the memory a task needs does not
grow with the text; a part is bounded by the token limit. One text is one task at a time, as each decision depends on the one
before; different texts are spread. Texts are cut into units once, and their rows shuffled once to be packed and once to be counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import let, strip, tokens
from corpusloom.operators.sections import fits, heading_blocks, pack_units, part_markers_of, split_heading
from corpusloom.options import ChunkOptions

_PACKED = "key bigint, part_no int, body string, headings array<string>"
_ARROW = pa.schema(
    [("key", pa.int64()), ("part_no", pa.int32()), ("body", pa.string()), ("headings", pa.list_(pa.string()))]
)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, unit_no, text, ...) sorted by key and unit: a row per part, with the headings its rows bring."""
    key, total, part_no, pieces, headings = None, 0, 0, [], []

    def part() -> tuple:
        return key, part_no, "".join(piece for _, piece in sorted(pieces)), headings

    for batch in batches:
        closed = []
        for own, unit_no, text, n, first, sep, limit, heading in zip(*[column.to_pylist() for column in batch.columns]):
            other = part_no == 0 or own != key
            if other or first or total + n > limit:
                if pieces:
                    closed.append(part())
                key, total, part_no, pieces, headings = own, n, 1 if other else part_no + 1, [(unit_no, text)], []
            else:
                total += n
                pieces.append((unit_no, sep + text))
            if heading is not None:
                headings.append(heading)
        if closed:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*closed), _ARROW)], schema=_ARROW)
    if pieces:
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(part(), _ARROW)], schema=_ARROW)


def packed_rows(units: DataFrame) -> DataFrame:
    """units: key bigint, unit_no int, text, tokens, first, sep, limit, heading. Bodies of at most `limit` tokens: key, part_no, body, headings.

    A key's units are numbered without repeats. NULL keys are one key. `headings` are those of a part's units that are not NULL.
    """
    ordered = units.repartition("key").sortWithinPartitions("key", "unit_no")
    return ordered.select("key", "unit_no", "text", "tokens", "first", "sep", "limit", "heading").mapInArrow(_packed, _PACKED)


def split_oversized_rows(
    texts: DataFrame, key: str, text: str, options: ChunkOptions = ChunkOptions()
) -> DataFrame:
    """`key, piece_no, text` for texts with unique keys: what fits as it is, else parts under the limit with the heading repeated."""
    given = texts.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    content = F.col("text")

    def measured(h: Column) -> Column:
        limit = F.greatest(F.lit(options.max_tokens) - tokens(h["title"]) - options.heading_reserve, F.lit(1))
        return F.struct(h["heading"].alias("heading"), limit.alias("limit"), heading_blocks(h).alias("blocks"))

    def bare(h: Column) -> Column:
        return (strip(h["lead"]) == "") & (strip(h["content"]) == "")

    known = given.select("key", F.explode(F.array(F.when(~fits(content, options.max_tokens), let(split_heading(content), measured)))).alias("cut"))
    stays = F.when(~fits(content, options.max_tokens), let(split_heading(content), bare)).otherwise(True)
    whole = given.where(stays).select("key", F.lit(1).alias("piece_no"), "text")
    split = known.where("key IS NOT NULL AND size(cut.blocks) > 0")
    units = split.select(
        "key", "cut.heading", "cut.limit", F.posexplode(pack_units(F.col("cut.blocks"), F.col("cut.limit"))).alias("unit_no", "u")
    )
    heading = F.when(F.col("unit_no") == 0, F.col("heading")).alias("heading")
    bodies = packed_rows(units.select("key", "unit_no", "u.*", "limit", heading))
    own = Window.partitionBy("key")
    counted = bodies.select(
        "key", "part_no", "body", F.max("part_no").over(own).alias("parts"), F.flatten(F.collect_list("headings").over(own)).alias("headings")
    )
    headed = counted.select("key", "part_no", "body", "parts", F.explode("headings").alias("heading"))
    text_of = part_markers_of(F.col("body"), F.col("part_no") - 1, F.col("parts"), F.col("heading"))
    made = headed.select("key", F.col("part_no").alias("piece_no"), text_of.alias("text"))
    return whole.unionByName(made).withColumnRenamed("key", key)
