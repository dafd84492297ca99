"""Chunks under a token limit: recombining, orphan headings, oversized chunks.

Decisions are made on small numbers per unit; texts are joined once, afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.markdown import starts_with_heading
from corpusloom.functions.text import (
    at_least_words,
    is_blank,
    let,
    lines_of,
    non_empty,
    runs,
    strip,
    tokens,
    tokens_of_words,
    words,
)
from corpusloom.options import ChunkOptions


MARKS_PER_STRING = 1024


def _marks(units: Column, state_type: str, zero: str, step) -> Column:
    """Walk the units once and return one '1' (opens a group) or '0' per unit, as an array.

    `step(state, unit)` returns (opens, next_state). Marks are gathered MARKS_PER_STRING at a time,
    so that a unit copies no more than one of them and only every so many units copy what is there.
    """
    start = F.struct(
        F.expr(f"cast({zero} as {state_type})").alias("state"),
        F.lit("").alias("marks"),
        F.lit("").alias("full"),
    )

    def merge(acc: Column, unit: Column) -> Column:
        opens, after = step(acc["state"], unit)
        mark = F.when(opens, F.lit("1")).otherwise(F.lit("0"))
        is_full = F.octet_length(acc["marks"]) >= MARKS_PER_STRING
        return F.struct(
            after.cast(state_type).alias("state"),
            F.when(is_full, mark).otherwise(F.concat(acc["marks"], mark)).alias("marks"),
            F.when(is_full, F.concat(acc["full"], acc["marks"])).otherwise(acc["full"]).alias("full"),
        )

    return F.split(F.aggregate(units, start, merge, lambda acc: F.concat(acc["full"], acc["marks"])), "")


def recombine(chunks: Column, options: ChunkOptions = ChunkOptions()) -> Column:
    """Join chunks without a heading to the section before them while it fits the limit.

    A chunk that opens with a heading always opens a section. So words are counted only of chunks
    that may be joined to another one; others count as none.
    """

    def counted(bound: Column, headings: Column) -> Column:
        def unit(c: Column, i: Column) -> Column:
            own = F.get(headings, i)
            before_heading = F.when(i + 1 < F.size(headings), F.get(headings, i + 1)).otherwise(True)
            matters = F.coalesce((~own & (i > 0)) | ~before_heading, F.lit(True))
            n_words = F.when(matters, words(c).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
            return F.struct(n_words.alias("words"), own.alias("heading"))

        return F.transform(bound, unit)

    def joined(bound: Column) -> Column:
        units = let(F.transform(bound, lambda c: starts_with_heading(c)), lambda headings: counted(bound, headings))

        def step(total: Column, unit: Column):
            opens = (
                (total < 0)
                | unit["heading"]
                | (tokens_of_words(total + unit["words"]) > options.max_tokens)
            )
            return opens, F.when(opens, unit["words"]).otherwise(total + unit["words"])

        return let(
            _marks(units, "bigint", "-1", step),
            lambda marks: runs(bound, lambda _, i: F.get(marks, i) == "1", "\n\n"),
        )

    return _if_several(chunks, joined)


def _if_several(chunks: Column, joined) -> Column:
    """`joined(chunks)`; one chunk has nothing to be joined to."""
    return let(
        chunks,
        lambda c: F.when(F.size(c) == 1, F.transform(c, lambda one: F.coalesce(one, F.lit("")))).otherwise(joined(c)),
    )


def merge_orphans(chunks: Column, options: ChunkOptions = ChunkOptions()) -> Column:
    """Join a short heading-only chunk to its successor; the result is not looked at again.

    With one letter per chunk (s: short heading, c: other) taking pairs from the left is a
    regex replacement: in 'sx' the x is taken in by the s.
    """

    def joined(bound: Column) -> Column:
        short = F.transform(
            bound,
            lambda c: F.when(
                starts_with_heading(c) & ~at_least_words(c, options.orphan_words), F.lit("s")
            ).otherwise(F.lit("c")),
        )
        taken = F.split(F.regexp_replace(F.array_join(short, ""), "s.", "s-"), "")
        return let(taken, lambda t: runs(bound, lambda _, i: F.get(t, i) != "-", "\n\n"))

    return _if_several(chunks, joined)


def blocks_of(text: Column) -> Column:
    """Cut a text into blocks: before a heading, a bullet, or the first blank line after text."""

    def cut(lines: Column) -> Column:
        def opens(line: Column, i: Column) -> Column:
            return (
                (F.contains(line, F.lit("#")) & F.rlike(line, F.lit(r"^\s*#{1,6}\s+\S")))
                | (is_blank(line) & ~is_blank(F.get(lines, i - 1)))
                | (F.contains(line, F.lit("*")) & F.rlike(line, F.lit(r"^(?! )\s*\*")))
            )

        return runs(lines, opens, "\n")

    return let(lines_of(text), cut)


def sentences_of(text: Column) -> Column:
    return F.split(text, fv.SENTENCE_END)


def split_heading(chunk: Column) -> Column:
    """STRUCT<heading, title, lead, content>: the first heading and the text around it."""
    parts = r"(?m)(?d)\A((?s:.*?))(" + fv.MAIN_HEADING.replace("(?m)(?d)", "") + r")\n?((?s:.*))\z"

    def build(c: Column) -> Column:
        found = F.regexp_extract(c, parts, 2)
        return let(
            found,
            lambda h: F.when(
                h != "",
                F.struct(
                    h.alias("heading"),
                    strip(F.substring_index(h, "\n", 1)).alias("title"),
                    F.regexp_extract(c, parts, 1).alias("lead"),
                    F.regexp_extract(c, parts, 3).alias("content"),
                ),
            ).otherwise(
                F.struct(
                    F.lit(fv.DEFAULT_HEADING).alias("heading"),
                    F.lit(fv.DEFAULT_HEADING).alias("title"),
                    F.lit("").alias("lead"),
                    c.alias("content"),
                )
            ),
        )

    return let(chunk, build)


def main_heading(chunk: Column) -> Column:
    """The first heading line of a chunk (with its underline), else a fixed one."""
    return F.coalesce(non_empty(F.regexp_extract(chunk, fv.MAIN_HEADING, 0)), F.lit(fv.DEFAULT_HEADING))


def part_markers_of(body: Column, k: Column, n: Column, heading: Column) -> Column:
    """Part `k`, from 0, of `n`: the heading, which part it is, and the body."""
    first = F.concat(
        heading,
        F.lit("\n\n"),
        body,
        F.when(n > 1, F.lit("\n\n**[Continued in Part 2]**")).otherwise(F.lit("")),
    )
    later = F.concat(
        heading,
        F.lit("\n\n**[Part "),
        (k + 1).cast("string"),
        F.lit(" of "),
        n.cast("string"),
        F.lit(" - Continued]**\n\n"),
        body,
    )
    return F.when(k == 0, first).otherwise(later)


def part_markers(bodies: Column, heading: Column) -> Column:
    """Repeat the heading on every part and say which part it is."""
    return let(bodies, lambda b: F.transform(b, lambda body, k: part_markers_of(body, k, F.size(b), heading)))


def part_text(heading: str, body: str, k: int, n: int) -> str:
    """Part `k` of `n` as `part_markers` writes it."""
    if k:
        return f"{heading}\n\n**[Part {k + 1} of {n} - Continued]**\n\n{body}"
    return f"{heading}\n\n{body}" + ("\n\n**[Continued in Part 2]**" if n > 1 else "")


# A block with more characters is likely above the limit; either way it is counted exactly.
CHARS_PER_TOKEN = 5


def pack_units(blocks: Column, limit: Column) -> Column:
    """What is packed, as ARRAY<STRUCT<text, tokens, first, sep>>: blocks, and the sentences of blocks above the limit.

    Sentences are cut at white space, so they have the words of their block. A long block is cut first and counted
    by its sentences, a shorter one as a whole; so few words are counted twice.
    """

    def sentences(block: Column) -> Column:
        return F.transform(
            sentences_of(block), lambda s: F.struct(s.alias("text"), words(s).cast("bigint").alias("words"))
        )

    def cut(found: Column) -> Column:
        return F.transform(
            found,
            lambda s, i: F.struct(
                s["text"].alias("text"),
                tokens_of_words(s["words"]).alias("tokens"),
                (i == 0).alias("first"),
                F.lit("\n").alias("sep"),
            ),
        )

    def whole(block: Column, n: Column) -> Column:
        return F.array(
            F.struct(
                block.alias("text"), n.alias("tokens"), F.lit(False).alias("first"), F.lit("\n\n").alias("sep")
            )
        )

    def counted_by_sentence(block: Column, found: Column) -> Column:
        n_words = F.aggregate(found, F.lit(0).cast("bigint"), lambda total, s: total + s["words"])
        return let(
            tokens_of_words(n_words), lambda n: F.when(n > limit, cut(found)).otherwise(whole(block, n))
        )

    def units(block: Column) -> Column:
        counted = let(
            tokens(block), lambda n: F.when(n > limit, cut(sentences(block))).otherwise(whole(block, n))
        )
        is_long = F.length(block) > CHARS_PER_TOKEN * limit
        return F.when(is_long, let(sentences(block), lambda found: counted_by_sentence(block, found))).otherwise(counted)

    return F.flatten(F.transform(blocks, units))


def pack_blocks(blocks: Column, limit: Column) -> Column:
    """Pack blocks into bodies of at most `limit` tokens.

    A block above the limit opens a body and is packed sentence by sentence; the last
    body stays open for the next block. Sentences join by a line break, blocks by a blank line.
    """

    def packed(bound: Column) -> Column:
        def step(total: Column, unit: Column):
            opens = (total < 0) | unit["first"] | (total + unit["tokens"] > limit)
            return opens, F.when(opens, unit["tokens"]).otherwise(total + unit["tokens"])

        def assemble(marks: Column) -> Column:
            pieces = F.transform(
                bound,
                lambda u, i: F.when(F.get(marks, i) == "1", u["text"]).otherwise(
                    F.concat(u["sep"], u["text"])
                ),
            )
            return runs(pieces, lambda _, i: F.get(marks, i) == "1", "")

        return let(_marks(bound, "bigint", "-1", step), assemble)

    return let(pack_units(blocks, limit), packed)


# No text is as long as this many words.
MOST_WORDS = 2**31 - 1


def fits(chunk: Column, max_tokens: int) -> Column:
    """The chunk has at most `max_tokens`. A short one cannot have more; of others no more words are read than the limit has."""
    most_words = (F.length(chunk) + 1) / 2
    too_many = (10 * max_tokens + 9) // fv.TOKENS_PER_10_WORDS + 1
    return (tokens_of_words(most_words) <= max_tokens) | ~at_least_words(chunk, min(max(too_many, 0), MOST_WORDS))


def heading_blocks(h: Column) -> Column:
    """Blocks of a chunk as `split_heading` gives it, lines before the heading first; none if it is only a heading."""
    none = F.array().cast("array<string>")
    lead = F.regexp_replace(h["lead"], r"\n\z", "")
    blocks = F.concat(
        F.when(~is_blank(lead), blocks_of(lead)).otherwise(none),
        F.when(h["content"] != "", blocks_of(h["content"])).otherwise(none),
    )
    return F.when(is_blank(h["lead"]) & is_blank(h["content"]), none).otherwise(blocks)


def split_oversized(chunk: Column, options: ChunkOptions = ChunkOptions()) -> Column:
    """One chunk to ARRAY<STRING>: itself, or parts under the limit with its heading repeated.

    Lines before the heading become the first block. A chunk that is only a heading stays.
    """

    def parts(h: Column, whole: Column) -> Column:
        limit = F.greatest(
            F.lit(options.max_tokens) - tokens(h["title"]) - options.heading_reserve, F.lit(1)
        )
        bodies = let(limit, lambda bound: pack_blocks(heading_blocks(h), bound))
        return F.when(is_blank(h["lead"]) & is_blank(h["content"]), F.array(whole)).otherwise(
            part_markers(bodies, h["heading"])
        )

    return let(
        chunk,
        lambda c: F.when(fits(c, options.max_tokens), F.array(c)).otherwise(
            let(split_heading(c), lambda h: parts(h, c))
        ),
    )


def chunks_under_limit(chunks: Column, options: ChunkOptions = ChunkOptions()) -> Column:
    """Recombine, merge orphan headings, split what is still too large."""
    merged = merge_orphans(recombine(chunks, options), options)
    return F.flatten(F.transform(merged, lambda c: split_oversized(c, options)))
