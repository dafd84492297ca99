"""Column helpers for text: stripping, counting, lines and runs of lines.

Every helper maps a column to a column inside one row, so none of them shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times in `body`."""
    return F.transform(F.array(value), lambda bound: body(bound))[0]


def strip(text: Column) -> Column:
    """Drop white space at both ends; linear, unlike an anchored regex."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def is_blank(text: Column) -> Column:
    """Nothing is left of the text when it is stripped; reads no further than the first other character."""
    return F.ltrim(text, F.lit(fv.WHITESPACE)) == ""


def words(text: Column) -> Column:
    """Number of words. A simple text is cut at its spaces and newlines, which is faster than a regex."""

    def counted(t: Column) -> Column:
        cut = F.split(F.replace(t, F.lit("\n"), F.lit(" ")), " ")
        return F.when(F.rlike(t, F.lit(fv.SIMPLE_TEXT)), F.size(F.array_remove(cut, ""))).otherwise(
            F.size(F.regexp_extract_all(t, F.lit(fv.WORD), F.lit(0)))
        )

    return let(text, counted)


def tokens_of_words(n_words: Column) -> Column:
    return F.floor(n_words * fv.TOKENS_PER_10_WORDS / 10).cast("bigint")


def tokens(text: Column) -> Column:
    """Token estimate: 1.3 per word, rounded down."""
    return tokens_of_words(words(text).cast("bigint"))


def at_least_words(text: Column, n: int) -> Column:
    """True if the text has `n` or more words; reads no further than the n-th."""
    return F.rlike(text, F.lit(rf"\A(?:{fv.BLANK_CHAR}*+{fv.WORD}){{{n}}}+"))


def rewrite_if(text: Column, pattern: str, replacement: str, needed) -> Column:
    """One regex rewrite, skipped where the condition `needed(text)` does not hold."""
    return let(
        text, lambda t: F.when(needed(t), F.regexp_replace(t, pattern, replacement)).otherwise(t)
    )


def rewrite(text: Column, steps) -> Column:
    """Regex rewrites (pattern, replacement, needed texts), skipped where no needed text occurs."""

    def occurs(needed):
        def any_of(t: Column) -> Column:
            found = F.contains(t, F.lit(needed[0]))
            for other in needed[1:]:
                found = found | F.contains(t, F.lit(other))
            return found

        return any_of

    for pattern, replacement, *needed in steps:
        if needed:
            text = rewrite_if(text, pattern, replacement, occurs(needed))
        else:
            text = F.regexp_replace(text, pattern, replacement)
    return text


def all_lines(text: Column) -> Column:
    """Lines by any line end, not only the newline."""
    return F.split(F.replace(text, F.lit("\r\n"), F.lit("\n")), fv.OTHER_LINE_END)


def non_empty(text: Column) -> Column:
    """NULL instead of an empty string, for use in coalesce."""
    return F.nullif(text, F.lit(""))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def first_match(text: Column, patterns, group: int = 1) -> Column:
    """The group of the first pattern in the list that matches, else NULL."""
    return F.coalesce(*[non_empty(F.regexp_extract(text, p, group)) for p in patterns])


def cut_before(text: Column, rest: Column) -> Column:
    """`text` without its ending `rest`."""
    return F.substring(text, F.lit(1), F.length(text) - F.length(rest))


def signature(lines: Column, classify: Callable[[Column], Column]) -> Column:
    """One letter per line, joined, so that line patterns become short regexes."""
    return F.array_join(F.transform(lines, lambda line: classify(line)), "")


def join_slice(lines: Column, start: Column, length: Column, sep: str = "\n") -> Column:
    """Join `length` entries from the 0-based `start`."""
    return F.array_join(F.slice(lines, start + 1, length), sep)


RUN_MARK = "\x01"


def runs(units: Column, opens: Callable[[Column, Column], Column], sep: str) -> Column:
    """Cut an array into runs and join each: `opens(unit, index)` tells where one begins.

    The first unit always opens a run. Units are joined once, with a mark between runs, and cut at the marks, so the
    cost is linear in the array. Where a unit is NULL or holds the mark, each run is sliced out and joined instead.
    """

    def marked(bound: Column) -> Column:
        def piece(unit: Column, i: Column) -> Column:
            joins = F.when(F.coalesce(opens(unit, i), F.lit(False)), F.lit(RUN_MARK)).otherwise(F.lit(sep))
            return F.when(i == 0, unit).otherwise(F.concat(joins, unit))

        return F.split(F.array_join(F.transform(bound, piece), ""), RUN_MARK)

    def cut(bound: Column) -> Column:
        unsafe = F.exists(bound, lambda unit: unit.isNull() | F.contains(unit, F.lit(RUN_MARK)))
        return F.when((F.size(bound) > 0) & ~unsafe, marked(bound)).otherwise(sliced(bound))

    def sliced(bound: Column) -> Column:
        n = F.size(bound)
        starts = F.filter(
            F.transform(
                bound,
                lambda unit, i: F.when((i == 0) | F.coalesce(opens(unit, i), F.lit(False)), i),
            ),
            lambda i: i.isNotNull(),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda start, k: join_slice(
                    bound, start, F.coalesce(F.get(at, k + 1), n) - start, sep
                ),
            ),
        )

    return let(units, cut)


NOTES_PER_STRING = 2048


def notes(units: Column, state_type: str, zero: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Walk an array once with a state and return one short string per entry: `step(state, unit)` is (string, next state).

    Strings hold no semicolon. They are gathered some thousand bytes at a time, so an entry copies no more than these.
    """
    start = F.struct(F.expr(f"cast({zero} as {state_type})").alias("state"), F.lit("").alias("recent"), F.lit("").alias("all"))

    def merge(acc: Column, unit: Column) -> Column:
        note, after = step(acc["state"], unit)
        recent = F.concat(acc["recent"], note, F.lit(";"))
        is_full = F.octet_length(acc["recent"]) >= NOTES_PER_STRING
        return F.struct(
            after.cast(state_type).alias("state"),
            F.when(is_full, F.concat(note, F.lit(";"))).otherwise(recent).alias("recent"),
            F.when(is_full, F.concat(acc["all"], acc["recent"])).otherwise(acc["all"]).alias("all"),
        )

    return F.split(F.aggregate(units, start, merge, lambda acc: F.concat(acc["all"], acc["recent"])), ";")


def buckets(units: Column, per_bucket: int) -> Column:
    """Cut an array into arrays of `per_bucket` entries; the last may be shorter."""
    return let(
        units,
        lambda bound: F.when(
            F.size(bound) > 0,
            F.transform(
                F.sequence(F.lit(0), F.size(bound) - 1, F.lit(per_bucket)),
                lambda start: F.slice(bound, start + 1, F.lit(per_bucket)),
            ),
        ).otherwise(F.slice(F.array(bound), 1, 0)),
    )


def drop_blank(texts: Column) -> Column:
    """Strip every entry and keep those with something left."""
    return F.filter(F.transform(texts, lambda t: strip(t)), lambda t: t != "")
