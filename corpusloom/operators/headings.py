"""Cutting a markdown text into chunks at headings. Column in, ARRAY<STRING> out.

A cut point is a zero-width match at a line start, so one regex pass does the work
and no text is lost. An underline is never itself taken for a title.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.markdown import starts_with_heading_or_number
from corpusloom.functions.text import drop_blank, let

SAME_LINE_BLANK = r"[^\S\n]"


def _cut(text: Column, *forms: str) -> Column:
    return drop_blank(F.split(text, r"(?m)(?d)^(?=" + "|".join(forms) + ")"))


def _underlined(mark: str, at_least: int) -> str:
    underline = f"{mark}{{{at_least},}}{SAME_LINE_BLANK}*$"
    return rf"(?!{underline})[^\s#][^\n]*\n{underline}"


def merge_preamble(chunks: Column, max_chars: int) -> Column:
    """Put a first chunk that is short and has no heading in front of the second."""
    return let(
        chunks,
        lambda c: F.when(
            (F.size(c) > 1)
            & ~starts_with_heading_or_number(F.get(c, F.lit(0)))
            & (F.length(F.get(c, F.lit(0))) <= max_chars),
            F.concat(
                F.array(F.concat(F.get(c, F.lit(0)), F.lit("\n\n"), F.get(c, F.lit(1)))),
                F.slice(c, F.lit(3), F.greatest(F.size(c) - 2, F.lit(0))),
            ),
        ).otherwise(c),
    )


def split_h3(text: Column) -> Column:
    """Cut at H3 lines and at titles underlined with dashes."""
    return _cut(text, "### ", r"[A-Za-z][^\n]*\n-+$")


def split_h2_h4(text: Column) -> Column:
    """Cut at H2 to H4 and at titles underlined with three or more dashes."""
    chunks = _cut(text, rf"#{{2,4}}{SAME_LINE_BLANK}+\S", _underlined("-", 3))
    return merge_preamble(chunks, 119)


def split_generic(
    text: Column,
    min_level: int = 2,
    include_setext: bool = True,
    include_numbered: bool = True,
    numbered_requires_hr: bool = True,
    merge_short_preamble: bool = True,
    preamble_chars: int = 160,
) -> Column:
    """Cut at ATX headings from `min_level` on, underlined titles and numbered lines.

    With `numbered_requires_hr` a numbered line counts if one of the three lines that
    start at the first non-blank line after it is a `***` rule.
    """
    forms = [rf"#{{{min_level},6}}{SAME_LINE_BLANK}+\S"]
    if include_setext and min_level <= 1:
        forms.append(_underlined("=", 1))
    if include_setext and min_level <= 2:
        forms.append(_underlined("-", 1))
    if include_numbered:
        numbered = rf"\d+\.{SAME_LINE_BLANK}+\S"
        if numbered_requires_hr:
            numbered += (
                rf"[^\n]*\n(?:{SAME_LINE_BLANK}*\n)*+(?:[^\n]*\n){{0,2}}?"
                rf"{SAME_LINE_BLANK}*\*{{3,}}{SAME_LINE_BLANK}*$"
            )
        forms.append(numbered)
    chunks = _cut(text, *forms)
    return merge_preamble(chunks, preamble_chars) if merge_short_preamble else chunks
