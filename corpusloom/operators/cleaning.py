"""Per-site cleaning, date capture and the cleaning registry. Column in, column out."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import cut_before, first_match, let, rewrite, rewrite_if, strip

REST = "(?s:.*)"


def _cut_at_line(text: Column, line_pattern: str) -> Column:
    """Drop everything from the first line that matches."""
    return F.regexp_replace(text, "(?im)(?d)" + line_pattern + REST, "")


def _cut_if(text: Column, line_pattern: str, confirm: str) -> Column:
    """Drop everything from the first matching line if `confirm` holds from there on.

    `confirm` is anchored and made of atomic steps, so it is tried once and never backtracks.
    """

    def cut(bound: Column) -> Column:
        return let(
            F.regexp_extract(bound, "(?im)(?d)" + line_pattern + REST, 0),
            lambda rest: F.when(
                (rest != "") & F.rlike(rest, F.lit(r"(?ims)(?d)\A" + confirm)),
                cut_before(bound, rest),
            ).otherwise(bound),
        )

    return let(text, cut)


# A link that may run over lines, then the start of the next line that opens with one.
_LINK = r"(?>\[.*?\]\(https?:)(?>.*?\))"
_NEXT_LINK_LINE = r"(?>.*?^(?=\[))"


def clean_header_footer(content: Column) -> Column:
    """Wiki form: drop the three-line header and everything from the footer on.

    Without that header the text is only stripped. Each footer marker cuts what the
    markers before it have left, in the listed order.
    """

    def body_of(bound: Column) -> Column:
        body = F.regexp_extract(bound["content"], fv.WIKI_HEADER + f"({REST})", 2)
        for marker in fv.WIKI_FOOTER_LINES:
            body = _cut_at_line(body, marker)
        body = _cut_if(
            body, fv.WIKI_SOCIAL_LINE, rf"(?>{fv.WIKI_SOCIAL_LINE})(?>.*?{fv.WIKI_SOCIAL_LINE})"
        )
        body = _cut_if(
            body, r"^\[", _LINK + _NEXT_LINK_LINE + _LINK + _NEXT_LINK_LINE + _LINK
        )
        body = _cut_if(
            body, fv.WIKI_RATING_LINE, r"(?>.*?PEGI)(?>.*?\]\()(?>.*?\)\])"
        )
        body = strip(F.regexp_replace(body, r"\n{3,}", "\n\n"))
        return F.concat(F.lit("### "), bound["title"], F.lit("\n\n"), body)

    return let(
        F.struct(
            content.alias("content"),
            F.regexp_extract(content, fv.WIKI_HEADER, 1).alias("title"),
        ),
        lambda b: F.when(b["title"] != "", body_of(b)).otherwise(strip(b["content"])),
    )


def _drop_first(text: Column, line_pattern: str) -> Column:
    """Delete the first line that matches, once."""
    return F.regexp_replace(text, r"(?im)(?d)\A((?s:.*?))" + line_pattern, "$1")


def clean_intro_anchor(content: Column) -> Column:
    """Blog form: title line to H1, text from the introduction to the author or disclaimer."""

    def cleaned(bound: Column) -> Column:
        title = F.when(
            F.contains(bound, F.lit(fv.BLOG_SUFFIX)), strip(first_match(bound, fv.BLOG_TITLES))
        )
        without_header = bound
        for line in fv.BLOG_HEADER_LINES:
            without_header = _drop_first(without_header, line)
        text = F.coalesce(
            first_match(bound, [p + REST for p in fv.INTRODUCTION], 0), without_header
        )
        text = F.regexp_replace(text, fv.BLOG_BREADCRUMB, "")
        text = F.substring_index(text, fv.BLOG_DISCLAIMER, 1)
        text = rewrite_if(
            text, fv.BLOG_QUICK_LINKS, "", lambda t: F.rlike(t, F.lit(fv.BLOG_QUICK_MARK))
        )
        text = F.regexp_replace(text, fv.BLOG_CLOSING + REST, "")
        return _titled(title, text)

    return let(content, lambda c: F.when(c == "", c).otherwise(cleaned(c)))


def clean_title_suffix(content: Column) -> Column:
    """Tool form: title line to H1, text from the introduction to the closing line."""

    def cleaned(bound: Column) -> Column:
        title = F.when(
            F.contains(bound, F.lit(fv.TOOL_SUFFIX)), strip(first_match(bound, [fv.TOOL_TITLE]))
        )
        stripped = strip(bound)
        text = F.coalesce(
            first_match(stripped, [p + REST for p in fv.TOOL_INTRODUCTION], 0),
            F.regexp_replace(stripped, r"(?im)(?d)\A(?s:.*?)" + fv.TOOL_BY_LINE, ""),
        )
        text = F.regexp_replace(text, fv.TOOL_CLOSING + REST, "")
        return _titled(title, text)

    return let(content, lambda c: F.when(c == "", c).otherwise(cleaned(c)))


def _titled(title: Column, text: Column) -> Column:
    return F.concat(
        F.lit("# "),
        F.coalesce(title, F.lit(fv.UNKNOWN_TITLE)),
        F.lit("\n\n"),
        strip(text),
        F.lit("\n"),
    )


def clean_default(content: Column) -> Column:
    """Any other page: drop inline links with their text, collapse line breaks."""
    text = rewrite(content, [(fv.INLINE_LINK, "$1", "](")])
    return strip(F.regexp_replace(text, r"\n+", "\n"))


CLEANERS: Mapping[str, Callable[[Column], Column]] = {
    fv.SITE_TOOL: clean_title_suffix,
    fv.SITE_WIKI: clean_header_footer,
    fv.SITE_BLOG: clean_intro_anchor,
}


def clean_by_url(
    content: Column,
    url: Column,
    cleaners: Mapping[str, Callable[[Column], Column]] = CLEANERS,
    default: Callable[[Column], Column] = clean_default,
) -> Column:
    """Apply the first cleaner whose domain occurs in the URL."""
    cleaned = None
    for domain, cleaner in cleaners.items():
        branch = F.contains(url, F.lit(domain))
        cleaned = (F if cleaned is None else cleaned).when(branch, cleaner(content))
    return default(content) if cleaned is None else cleaned.otherwise(default(content))


DATE_PATTERNS = {
    fv.SITE_WIKI: fv.DATE_WIKI,
    fv.SITE_BLOG: fv.DATE_BLOG,
    fv.SITE_TOOL: fv.DATE_TOOL,
}


def extract_date(content: Column, url: Column, patterns: Mapping[str, str] = DATE_PATTERNS) -> Column:
    """The date as the page prints it, or an empty string."""
    found = None
    for domain, pattern in patterns.items():
        branch = F.contains(url, F.lit(domain))
        found = (F if found is None else found).when(
            branch, strip(F.regexp_extract(content, pattern, 1))
        )
    return F.lit("") if found is None else found.otherwise(F.lit(""))
