"""HTML to markdown with built-in column functions.

Style: ATX headings, `*` bullets, `N.` for ordered lists, two blanks a level, fenced code, `_` emphasis, `**` strong, inline
links, `***` rules; images are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let, notes, rewrite, strip

# Elements whose whole content is dropped.
DROPPED = ("script", "style", "noscript", "title", "nav", "footer")

# An attribute value in double quotes, single quotes or none; one of its three groups is set.
_VALUE = r"""\s*=\s*(?:"([^"<>]*)"|'([^'<>]*)'|([^\s"'<>]++))"""

# Tag rewrites, applied in this order; a third value is the closing tag.
TAG_REWRITES = (
    (rf"(?i)<img\b[^<>]*?\balt{_VALUE}[^<>]*?\bsrc{_VALUE}[^<>]*>", "![$1$2$3]($4$5$6)"),
    (rf"(?i)<img\b[^<>]*?\bsrc{_VALUE}[^<>]*?\balt{_VALUE}[^<>]*>", "![$4$5$6]($1$2$3)"),
    (rf"(?i)<img\b[^<>]*?\bsrc{_VALUE}[^<>]*>", "![]($1$2$3)"),
    (r"(?is)<(?:b|strong)\b[^<>]*>(.*?)</(?:b|strong)\s*>", "**$1**", r"</(?:b|strong)\s*>"),
    (r"(?is)<(?:i|em)\b[^<>]*>(.*?)</(?:i|em)\s*>", "_$1_", r"</(?:i|em)\s*>"),
    (r"(?is)<code\b[^<>]*>(.*?)</code\s*>", "`$1`", r"</code\s*>"),
    (rf"(?is)<a\b[^<>]*?\bhref{_VALUE}[^<>]*>(.*?)</a\s*>", "[$4]($1$2$3)", r"</a\s*>"),
    (r"(?i)<h1\b[^<>]*>", "\n\n# "),
    (r"(?i)<h2\b[^<>]*>", "\n\n## "),
    (r"(?i)<h3\b[^<>]*>", "\n\n### "),
    (r"(?i)<h4\b[^<>]*>", "\n\n#### "),
    (r"(?i)<h5\b[^<>]*>", "\n\n##### "),
    (r"(?i)<h6\b[^<>]*>", "\n\n###### "),
    (r"(?i)<li\b[^<>]*>", "\n* "),
    (r"(?i)<br\b[^<>]*>", "\n"),
    (r"(?i)<hr\b[^<>]*>", "\n\n***\n\n"),
    (r"(?i)</?(?:h[1-6]|p|div|section|article|main|header|aside|blockquote|ul|ol|table)\b[^<>]*>", "\n\n"),
    (r"<[^<>]+>", ""),
)

# The elements of the first of these rewrites, group by group; without any of its names a rewrite finds nothing. No rewrite puts
# `<` and a name into a text, so names are looked for once.
REWRITTEN = (
    (("img",), ("img",), ("img",)),
    (("b", "strong"), ("i", "em"), ("code",)),
    (("a",),),
    (("h1",), ("h2",), ("h3",), ("h4",), ("h5",), ("h6",)),
    (("li",), ("br",), ("hr",)),
)
REWRITTEN_NAMES = r"(?i)</?(img|strong|code|em|li|br|hr|h[1-6]|[abi])\b"

# A character reference after its ampersand: decimal, hexadecimal or named.
# The longest name has 31 letters; only leading zeros make a reference longer than REFERENCE_CHARS.
REFERENCE_CHARS = 40
REFERENCE = r"\A#0*+(\d{1,7});|\A#[xX]0*+([0-9a-fA-F]{1,6});|\A([A-Za-z][A-Za-z0-9]*+);"

def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@cache
def _names_by_letter() -> dict[str, str]:
    """The names of HTML from the standard library as SQL maps by first letter; a blank that does not break is a blank."""
    groups: dict[str, list[str]] = {}
    for name, text in sorted(html5.items()):
        if name.endswith(";"):
            entry = f"{_quoted(name[:-1])},{_quoted(' ' if name == 'nbsp;' else text)}"
            groups.setdefault(name[0], []).append(entry)
    return {letter: f"map({','.join(entries)})" for letter, entries in groups.items()}


def _named(name: Column) -> Column:
    """The text of a named reference, or NULL."""
    first = F.substring(name, 1, 1)
    found = F.lit(None).cast("string")
    for letter, names in _names_by_letter().items():
        found = F.when(first == letter, F.try_element_at(F.expr(names), name)).otherwise(found)
    return found


def unescape(text: Column) -> Column:
    """Character references to characters, each once; others stay as they are."""

    def decode(piece: Column, i: Column) -> Column:
        def replaced(found: Column) -> Column:
            code = F.coalesce(
                F.try_to_number(found["decimal"], F.lit("9999999")).cast("int"),
                F.conv(F.nullif(found["hex"], F.lit("")), 16, 10).cast("int"),
            )
            usable = (code > 31) & (code < 1114112) & ~code.between(55296, 57343)
            char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
            new = F.when(usable, char).when(found["name"] != "", _named(found["name"]))
            rest = F.substring(piece, F.length(found["all"]) + 1, F.length(piece))
            return F.coalesce(F.concat(new, rest), F.concat(F.lit("&"), piece))

        def matched(start: Column) -> Column:
            groups = ((0, "all"), (1, "decimal"), (2, "hex"), (3, "name"))
            return F.struct(*[F.regexp_extract(start, REFERENCE, k).alias(n) for k, n in groups])

        zeros = piece.startswith("#0") | piece.startswith("#x0") | piece.startswith("#X0")
        start = F.when(zeros, piece).otherwise(F.substring(piece, 1, REFERENCE_CHARS))
        return F.when(i == 0, piece).otherwise(let(let(start, matched), replaced))

    return let(
        text,
        lambda t: F.when(
            F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), decode), "")
        ).otherwise(t),
    )


# White space that is not one blank already; the marks below count as white space.
BLANKS = r"[\t\n\x0b\f\r\x01-\x03][\s\x01-\x03]*+| [\s\x01-\x03]++"

# Marks of list lines until blanks have been collapsed: line start, indentation, end of a list.
_LINE, _INDENT, _END = "\x01", "\x02", "\x03"
LIST_TAG = r"(?i)</?(?:[uo]l|li)\b[^<>]*>"
TABLE_TAG = r"(?i)</?(?:table|tr|t[hd])\b[^<>]*>"


def _has_end(tags: Column, opens: Callable[[Column], Column], ends: Callable[[Column], Column]) -> Column:
    """For each tag, as an array read from its end, '1' if it opens an element that is closed later on."""

    def step(free: Column, tag: Column):
        note = F.when(opens(tag) & (free > 0), F.lit("1")).otherwise(F.lit("0"))
        after = F.when(opens(tag), F.greatest(free - 1, F.lit(0))).when(ends(tag), free + 1).otherwise(free)
        return note, after

    return notes(F.reverse(tags), "int", "0", step)


def _rewrite_tags(text: Column, pattern: str, noted: Callable[[Column], Column], write) -> Column:
    """A text cut at its tags: `noted(tags)` notes something for each, `write(tag, note, text after it)` gives what replaces both."""

    def joined(b: Column) -> Column:
        parts = F.transform(b["tags"], lambda tag, i: write(tag, F.get(b["notes"], i), F.get(b["gaps"], i + 1)))
        return F.concat(F.get(b["gaps"], F.lit(0)), F.array_join(parts, ""))

    tags = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(
        tags,
        lambda t: let(F.struct(t.alias("tags"), noted(t).alias("notes"), F.split(text, pattern, -1).alias("gaps")), joined),
    )


def _marked_closed(kinds: Column, opens: Callable[[Column], Column], ends: Callable[[Column], Column]) -> Column:
    """ARRAY<STRUCT<tag, closed>>: whether each tag opens an element that has an end.

    Mostly all have one, which a walk that only counts finds out; tag by tag it is noted in other texts alone.
    """

    def count(free: Column, tag: Column) -> Column:
        return F.when((free < 0) | (opens(tag) & (free == 0)), -1).when(opens(tag), free - 1).when(ends(tag), free + 1).otherwise(free)

    def noted(k: Column) -> Column:
        return let(
            _has_end(k, opens, ends),
            lambda closed: F.transform(
                k,
                lambda tag, i: F.struct(tag.alias("tag"), (F.get(closed, F.size(k) - 1 - i) == "1").alias("closed")),
            ),
        )

    def marked(k: Column) -> Column:
        all_closed = F.aggregate(F.reverse(k), F.lit(0), count) >= 0
        return F.when(all_closed, F.transform(k, lambda tag: F.struct(tag.alias("tag"), F.lit(True).alias("closed")))).otherwise(noted(k))

    return let(kinds, marked)


def _kind(tag: Column) -> Column:
    """The first two characters of a tag after its bracket, in lower case."""
    return F.lower(F.substring(tag, 2, 2))


def nested_lists(html: Column) -> Column:
    """Lists of any depth to marked lines: ordered items get numbers, an inner list two more blanks a level.

    One walk over the list tags with a stack of open lists, which holds the number of the last item, or -1 for a bullet list. A list
    without an end is none: its tags stay and become plain breaks and bullets later.
    """

    def step(stack: Column, unit: Column):
        tag, depth = unit["tag"], F.size(stack)
        opens = tag.isin("ul", "ol") & unit["closed"]
        number = F.element_at(stack, -1) + 1
        inside = depth > 0
        note = (
            F.when(opens, F.lit("open"))
            .when(~inside | tag.isin("ul", "ol"), F.lit("keep"))
            .when(tag == "/l", F.lit("open"))
            .when(tag != "li", F.concat(F.lit("end "), (depth - 1).cast("string")))
            .when(number == 0, F.concat(depth.cast("string"), F.lit(" *")))
            .otherwise(F.concat(depth.cast("string"), F.lit(" "), number.cast("string"), F.lit(".")))
        )
        counted = F.concat(F.slice(stack, F.lit(1), depth - 1), F.array(number))
        after = (
            F.when(opens, F.concat(stack, F.array(F.when(tag == "ul", F.lit(-1)).otherwise(F.lit(0)))))
            .when(inside & tag.isin("/u", "/o"), F.slice(stack, F.lit(1), depth - 1))
            .when(inside & (tag == "li") & (number > 0), counted)
            .otherwise(stack)
        )
        return note, after

    def noted(tags: Column) -> Column:
        kinds = F.transform(tags, _kind)
        units = _marked_closed(kinds, lambda k: k.isin("ul", "ol"), lambda k: k.isin("/u", "/o"))
        return notes(units, "array<int>", "array()", step)

    def write(tag: Column, note: Column, after: Column) -> Column:
        depth = F.substring_index(note, " ", 1).cast("int")
        bullet = F.substring_index(note, " ", -1)
        unwrapped = F.regexp_replace(after, r"(?i)\A\s*<p\b[^<>]*>", "")
        item = F.ltrim(F.when(F.contains(after, F.lit("<")), unwrapped).otherwise(after))
        end_depth = bullet.try_cast("int")
        follows = strip(after)
        return (
            F.when(note == "keep", F.concat(tag, after))
            .when(note == "open", F.when(follows == "", F.lit("")).otherwise(F.concat(F.lit(" "), follows)))
            .when(note == "end 0", F.concat(F.lit(_END), after))
            .when(
                note.startswith("end"),
                F.when(follows == "", F.lit("")).otherwise(
                    F.concat(F.lit(_LINE), F.repeat(F.lit(_INDENT), end_depth), follows)
                ),
            )
            .otherwise(F.concat(F.lit(_LINE), F.repeat(F.lit(_INDENT), depth - 1), bullet, F.lit(" "), item))
        )

    return let(
        html,
        lambda t: F.when(F.rlike(t, F.lit(r"(?i)</[uo]l\s*>")), _rewrite_tags(t, LIST_TAG, noted, write)).otherwise(t),
    )


def inner_tables(html: Column) -> Column:
    """Tables within tables to plain text of the cell around them, at any depth."""

    def noted(tags: Column) -> Column:
        kinds = F.transform(tags, lambda tag: F.lower(F.substring(tag, 2, 3)))
        def step(depth: Column, unit: Column):
            opens = (unit["tag"] == "tab") & unit["closed"]
            ends = (unit["tag"] == "/ta") & (depth > 0)
            within = depth + F.when(opens, 1).otherwise(0)
            note = F.when(within > 1, F.lit("drop")).otherwise(F.lit("keep"))
            return note, F.when(ends, depth - 1).otherwise(within)

        units = _marked_closed(kinds, lambda k: k == "tab", lambda k: k == "/ta")
        return notes(units, "int", "0", step)

    def write(tag: Column, note: Column, after: Column) -> Column:
        return F.concat(F.when(note == "drop", F.lit(" ")).otherwise(tag), after)

    return let(
        html,
        lambda t: F.when(
            F.size(F.split(t, r"(?i)<table\b", 3)) > 2, _rewrite_tags(t, TABLE_TAG, noted, write)
        ).otherwise(t),
    )


def _list_lines(text: Column) -> Column:
    """Marks to line breaks and blanks."""
    for mark, to in ((rf" ?{_END} ?", "\n\n"), (rf" ?{_LINE} ?", "\n"), (_INDENT, "  ")):
        text = F.regexp_replace(text, mark, to)
    return text


def rewrite_closed(text: Column, pattern: str, replacement: str, closing: str) -> Column:
    """Rewrite elements from opening to closing mark, up to the last closing mark.

    Behind that no element can end, so that an opening mark there would be looked for in vain
    through the whole rest of the text, each time anew.
    """

    def rewritten(t: Column) -> Column:
        return let(
            F.regexp_extract(t, rf"(?is)\A.*{closing}", 0),
            lambda head: F.when(
                head != "",
                F.concat(
                    F.regexp_replace(head, pattern, replacement),
                    F.substring(t, F.length(head) + 1, F.length(t)),
                ),
            ).otherwise(t),
        )

    return let(text, rewritten)


def table_rows(text: Column) -> Column:
    """Table rows to pipe rows, with a rule under each header row."""

    def row(inner: Column) -> Column:
        pieces = F.split(inner, r"(?i)<t[hd]\b[^<>]*>")
        cells = F.transform(
            F.slice(pieces, F.lit(2), F.size(pieces)),
            lambda cell: strip(F.regexp_replace(cell, r"(?i)</t[hd]\s*>", "")),
        )
        rule = F.when(F.rlike(inner, F.lit(r"(?i)<th\b")), F.lit(" --- |")).otherwise(F.lit(""))
        return let(
            F.struct(cells.alias("cells"), rule.alias("rule")),
            lambda r: F.when(
                F.size(r["cells"]) > 0,
                F.concat(
                    F.lit("\n| "),
                    F.array_join(r["cells"], " | "),
                    F.lit(" |"),
                    F.when(
                        r["rule"] != "",
                        F.concat(F.lit("\n|"), F.repeat(r["rule"], F.size(r["cells"]))),
                    ).otherwise(F.lit("")),
                ),
            ).otherwise(F.lit(" ")),
        )

    pieces = F.split(text, r"(?i)</?tr\b[^<>]*>")
    return F.array_join(
        F.transform(pieces, lambda p, i: F.when(i % 2 == 1, row(p)).otherwise(p)), ""
    )


def _rewritten(text: Column, steps) -> Column:
    for pattern, replacement, *closing in steps:
        text = rewrite_closed(text, pattern, replacement, closing[0]) if closing else F.regexp_replace(text, pattern, replacement)
    return text


def _without_tags(text: Column) -> Column:
    """All rewrites of tags; of those in REWRITTEN the ones whose elements the text holds: none, one, or else the whole group."""

    def some(text: Column, names: Column, group, steps) -> Column:
        def chosen(t: Column) -> Column:
            def holds(elements) -> Column:
                return F.arrays_overlap(names, F.array(*[F.lit(e) for e in sorted(set(elements))]))

            found = F.when(~holds(sum(group, ())), t)
            for elements, step in zip(group, steps):
                others = sum((e for e in group if e != elements), ())
                if others:
                    found = found.when(~holds(others), _rewritten(t, [step]))
            return found.otherwise(_rewritten(t, steps))

        return let(text, chosen)

    def with_names(b: Column) -> Column:
        t, at = b["text"], 0
        for group in REWRITTEN:
            t = some(t, b["names"], group, TAG_REWRITES[at : at + len(group)])
            at += len(group)
        return t

    def named(t: Column) -> Column:
        names = F.array_distinct(F.regexp_extract_all(t, F.lit(REWRITTEN_NAMES), F.lit(1)))
        return let(F.struct(t.alias("text"), F.transform(names, lambda n: F.lower(n)).alias("names")), with_names)

    return _rewritten(let(text, named), TAG_REWRITES[sum(map(len, REWRITTEN)) :])


def flow(html: Column) -> Column:
    """Everything outside preformatted blocks."""
    text = let(inner_tables(F.regexp_replace(html, BLANKS, " ")), table_rows)
    text = unescape(_without_tags(nested_lists(text)))
    text = rewrite(text, ((r"[ \t]+", " ", "  ", "\t"), (r" ?\n ?", "\n", " \n", "\n ")))
    text = let(text, lambda t: F.when(F.contains(t, F.lit(_END)), _list_lines(t)).otherwise(t))
    return strip(rewrite(text, ((r"\n{3,}", "\n\n", "\n\n\n"),)))


def fence(html: Column) -> Column:
    """A preformatted block: tags dropped, line breaks and indentation kept."""
    code = F.btrim(unescape(F.regexp_replace(html, r"<[^<>]+>", "")), F.lit("\n"))
    return let(
        code,
        lambda c: F.when(
            strip(c) != "", F.concat(F.lit("```\n"), c, F.lit("\n```"))
        ).otherwise(F.lit("")),
    )


def html_to_markdown(html: Column) -> Column:
    def without_comments(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("-->")), rewrite_closed(t, r"(?s)<!--.*?-->", "", "-->")).otherwise(t)

    def without_dropped(t: Column) -> Column:
        body = t
        for tag in DROPPED:
            closing = rf"</{tag}\s*>"
            body = rewrite_closed(body, rf"(?is)<{tag}\b[^<>]*>.*?{closing}", "", closing)
        return F.when(F.rlike(t, F.lit(rf"(?i)</(?:{'|'.join(DROPPED)})\s*>")), body).otherwise(t)

    body = let(let(html, without_comments), without_dropped)
    pieces = F.split(body, r"(?i)</?pre\b[^<>]*>")
    blocks = F.transform(pieces, lambda p, i: F.when(i % 2 == 1, fence(p)).otherwise(flow(p)))
    return F.array_join(F.filter(blocks, lambda b: b != ""), "\n\n")


def html_title(html: Column) -> Column:
    return strip(unescape(F.regexp_extract(html, r"(?i)<title\b[^<>]*>([^<]*)</title\s*>", 1)))
