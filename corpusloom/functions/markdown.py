"""Markdown columns: titles, plain text, heading context."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import (
    all_lines,
    first_match,
    let,
    lines_of,
    non_empty,
    rewrite,
    strip,
)


def guide_title(title: Column, content: Column) -> Column:
    """The fetched title, else the first H1, H2, H3, `Title:` line or line of the text."""
    return F.coalesce(
        non_empty(strip(title)),
        strip(first_match(content, fv.TITLE_LINES)),
        strip(F.substring_index(strip(content), "\n", 1)),
    )


def _plain_line(line: Column) -> Column:
    """NULL for a table rule; a pipe row becomes its cells joined by dashes."""
    cells = F.filter(
        F.transform(F.split(F.btrim(line, F.lit("|")), r"\|"), lambda c: strip(c)),
        lambda c: c != "",
    )
    return F.when(F.contains(line, F.lit("|")), F.array_join(cells, " - ")).otherwise(line)


def plain_text(content: Column, safe: bool = False) -> Column:
    """Markdown to plain text.

    Emphasis goes before lists and over lines, so pairs of `* ` bullets lose their marks and names lose underscores. With `safe` it
    goes after lists, within a line and not inside a word, and table rules with colons go too.
    """
    steps = fv.PLAIN_INLINE_SAFE if safe else fv.PLAIN_INLINE
    rule = fv.PLAIN_TABLE_RULE_SAFE if safe else fv.PLAIN_TABLE_RULE

    def without_pipes(text: Column) -> Column:
        lines = F.transform(all_lines(text), lambda line: strip(line))
        kept = F.filter(lines, lambda line: ~F.rlike(line, F.lit(rule)))
        collapsed = F.when(F.contains(text, F.lit("|")), F.transform(kept, _plain_line)).otherwise(lines)
        return F.array_join(collapsed, "\n")

    inline = rewrite(content, steps)
    return strip(rewrite(let(inline, without_pipes), fv.PLAIN_CLEANUP))


def plain_text_safe(content: Column) -> Column:
    """Markdown to plain text that keeps bullets and names whole."""
    return plain_text(content, safe=True)


def starts_with_heading(chunk: Column) -> Column:
    """The (stripped) chunk opens with an ATX heading or an underlined title."""
    return F.rlike(chunk, F.lit(fv.HEADING_START))


def starts_with_heading_or_number(chunk: Column) -> Column:
    """As above, and a numbered line counts too."""
    return F.rlike(chunk, F.lit(fv.HEADING_START_WIDE))


def headings(chunk: Column, limit: int = 3) -> Column:
    """The first headings of a chunk as ARRAY<STRUCT<level, title>>."""

    def found(lines: Column) -> Column:
        def one(line: Column, below: Column) -> Column:
            level = (
                F.when(line.startswith("#"), F.length(F.regexp_extract(line, "^#+", 0)))
                .when(below.startswith("==="), 1)
                .when(F.rlike(below, F.lit("^-{3,}$")), 2)
            )
            title = F.when(line.startswith("#"), strip(F.ltrim(line, F.lit("#")))).otherwise(line)
            return F.struct(level.cast("int").alias("level"), title.alias("title"))

        def may_be(line: Column, i: Column) -> Column:
            """Holds a mark, or the next line does; most lines are not stripped or looked at further."""
            below = F.get(lines, i + 1)
            marked = F.contains(line, F.lit("#")) | F.contains(below, F.lit("===")) | F.contains(below, F.lit("---"))
            return F.when(marked, one(strip(line), strip(F.coalesce(below, F.lit("")))))

        kept = F.filter(F.transform(lines, may_be), lambda h: h["level"].isNotNull() & (h["title"] != ""))
        return F.slice(kept, 1, limit)

    return let(lines_of(chunk), found)


def heading_context(chunk: Column) -> Column:
    """The first three headings, one per line, indented by level."""
    printed = F.transform(
        headings(chunk),
        lambda h: F.concat(
            F.repeat(F.lit("  "), h["level"] - 1),
            F.repeat(F.lit("#"), h["level"]),
            F.lit(" "),
            h["title"],
        ),
    )
    return F.coalesce(non_empty(F.array_join(printed, "\n")), F.lit(fv.DEFAULT_CONTEXT))
