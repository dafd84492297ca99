"""Long tables, lists and nested bullets: detection, and splitting with context repeated.

Each line is given one letter; look-ahead rules and extents are then short regexes over
the letters, in one pass over the lines of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import buckets, is_blank, join_slice, let, lines_of, runs, signature, strip
from corpusloom.options import StructureOptions


def _is(line: Column, pattern: str) -> Column:
    return F.rlike(line, F.lit(pattern))


def _opens_with(line: Column, characters: str) -> Column:
    """The line is empty or its first character is one of these; most lines need no regex after that."""
    return F.contains(F.lit(characters), F.substring(line, 1, 1))


def _bullet_letter(line: Column) -> Column:
    """m main bullet, s other star line, n nested, i indented by one, b blank, w other indented,
    k part marker, o other."""
    return (
        F.when(~_opens_with(line, "*" + fv.WHITESPACE), F.lit("o"))
        .when(_is(line, r"^\s*" + fv.PART_MARKER), F.lit("k"))
        .when(_is(line, fv.MAIN_BULLET_LINE), F.lit("m"))
        .when(_is(line, fv.STAR_LINE), F.lit("s"))
        .when(_is(line, fv.NESTED_LINE), F.lit("n"))
        .when(_is(line, fv.INDENTED_STAR_LINE), F.lit("i"))
        .when(is_blank(line), F.lit("b"))
        .when(_is(line, r"^\s"), F.lit("w"))
        .otherwise(F.lit("o"))
    )


def _table_letter(line: Column) -> Column:
    """r table rule, p other pipe row, o other."""
    stripped = strip(line)
    return (
        F.when(~_opens_with(line, "|" + fv.WHITESPACE), F.lit("o"))
        .when(~stripped.startswith("|"), F.lit("o"))
        .when(_is(stripped, fv.TABLE_RULE_LINE), F.lit("r"))
        .otherwise(F.lit("p"))
    )


def _is_item(line: Column) -> Column:
    return _opens_with(line, "*+-0123456789") & _is(line, fv.LIST_ITEM_LINE)


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def profile(text: Column, options: StructureOptions = StructureOptions()) -> Column:
    """STRUCT of counts and the kind of long structure the text holds, if any."""

    def counted(b: Column) -> Column:
        raw_rows = _count(b["table"], "p")
        return F.struct(
            F.when(raw_rows > 1, raw_rows - 1).otherwise(raw_rows).alias("table_rows"),
            b["items"].alias("list_items"),
            _count(b["bare"], "m[^mn]*n").alias("nested_groups"),
            _count(F.regexp_extract(b["bare"], "m.*", 0), "n").alias("nested_items"),
            F.rlike(b["plain"], F.lit("[ms][msb]{0,3}n")).alias("has_nested"),
        )

    def judged(c: Column) -> Column:
        nested = (c["nested_groups"] >= options.min_nested_groups) | (
            c["nested_items"] >= options.min_nested_items
        )
        table = c["table_rows"] >= options.min_table_rows
        listed = ~c["has_nested"] & (c["list_items"] >= options.min_list_items)
        return F.struct(
            *[c[name].alias(name) for name in ("table_rows", "list_items", "nested_groups", "nested_items")],
            nested.alias("is_nested"),
            table.alias("is_table"),
            listed.alias("is_list"),
            F.when(nested, F.lit("nested"))
            .when(table, F.lit("table"))
            .when(listed, F.lit("list"))
            .otherwise(F.lit("plain"))
            .alias("kind"),
        )

    def without_marker(line: Column) -> Column:
        marked = F.contains(line, F.lit(fv.PART_MARKER_START))
        return F.when(marked, F.regexp_replace(line, fv.PART_MARKER, "")).otherwise(line)

    def over(lines: Column) -> Column:
        unmarked = F.transform(lines, without_marker)
        return F.struct(
            signature(lines, _table_letter).alias("table"),
            signature(lines, _bullet_letter).alias("plain"),
            signature(unmarked, _bullet_letter).alias("bare"),
            F.size(F.filter(lines, _is_item)).alias("items"),
        )

    return let(let(let(let(text, lines_of), over), counted), judged)


def _parts(
    items: Column, per_part: int, unit: str, heading: Column, name: Column, body, rest: Column
) -> Column:
    """ARRAY<STRUCT<kind, text>>: parts of `per_part` items, then what follows them."""

    def one(bucket: Column, k: Column, n: Column) -> Column:
        marker = F.concat(
            F.lit("\n**[Part "),
            (k + 1).cast("string"),
            F.lit(f": {unit} "),
            (k * per_part + 1).cast("string"),
            F.lit("-"),
            (k * per_part + F.size(bucket)).cast("string"),
            F.lit(" of "),
            n.cast("string"),
            F.lit(" total"),
            F.when(name != "", F.concat(F.lit(" - "), name)).otherwise(F.lit("")),
            F.lit("]**\n"),
        )
        text = F.concat(
            F.when(heading != "", F.concat(heading, F.lit("\n\n"))).otherwise(F.lit("")),
            marker,
            F.lit("\n\n"),
            body(F.array_join(bucket, "\n")),
        )
        return F.struct(F.lit(unit.lower()).alias("kind"), text.alias("text"))

    def numbered(bound: Column) -> Column:
        return F.transform(
            buckets(bound, per_part), lambda bucket, k: one(bucket, k, F.size(bound))
        )

    trailing = let(
        rest,
        lambda r: F.when(
            r != "", F.array(F.struct(F.lit("rest").alias("kind"), r.alias("text")))
        ).otherwise(F.array().cast("array<struct<kind:string,text:string>>")),
    )
    return F.concat(let(items, numbered), trailing)


def _unsplit(text: Column) -> Column:
    return F.array(F.struct(F.lit("plain").alias("kind"), text.alias("text")))


def _name_of(last_line: Column, any_text: bool) -> Column:
    """A heading or bold line (or, for tables, any text) just above names the structure."""
    stripped = strip(last_line)
    return (
        F.when(stripped.startswith("#"), strip(F.ltrim(stripped, F.lit("#"))))
        .when(
            stripped.startswith("**") & stripped.endswith("**"),
            strip(F.btrim(stripped, F.lit("*"))),
        )
        .otherwise(stripped if any_text else F.lit(""))
    )


def _last(lines: Column, count: Column) -> Column:
    return F.when(count > 0, F.get(lines, count - 1)).otherwise(F.lit(""))


def split_table(
    text: Column, options: StructureOptions = StructureOptions(), keep_rest: bool = True
) -> Column:
    """Split the first table; heading, header and rule are repeated on every part."""

    def build(b: Column) -> Column:
        lines, start, extent = b["lines"], b["start"], b["extent"]
        table = F.transform(F.slice(lines, start + 1, extent), lambda line: strip(line))
        after = strip(join_slice(lines, start + extent, F.size(lines) - start - extent))
        rows = let(
            table,
            lambda t: F.struct(
                F.filter(t, lambda row: ~_is(row, fv.TABLE_RULE_LINE)).alias("rows"),
                F.filter(t, lambda row: _is(row, fv.TABLE_RULE_LINE)).alias("rules"),
            ),
        )
        described = let(
            rows,
            lambda t: F.struct(
                t["rows"].alias("rows"),
                strip(join_slice(lines, F.lit(0), start)).alias("heading"),
                _name_of(_last(lines, start), any_text=True).alias("name"),
                F.concat(
                    F.coalesce(F.get(t["rows"], F.lit(0)), F.lit("")),
                    F.lit("\n"),
                    F.coalesce(
                        F.concat(F.get(t["rules"], F.size(t["rules"]) - 1), F.lit("\n")), F.lit("")
                    ),
                ).alias("header"),
            ),
        )
        return let(
            described,
            lambda t: F.when(
                F.size(t["rows"]) > 1,
                _parts(
                    F.slice(t["rows"], F.lit(2), F.size(t["rows"]) - 1),
                    options.table_rows_per_part,
                    "Rows",
                    t["heading"],
                    t["name"],
                    lambda body: F.concat(t["header"], body),
                    after if keep_rest else F.lit(""),
                ),
            ).otherwise(_unsplit(b["text"])),
        )

    return _located(text, _table_letter, "[pr]", "^[pr]+", build)


def _located(text: Column, letter, first: str, extent: str, build) -> Column:
    """Find where the structure starts and how many lines it spans, then build its parts.

    Letters are ASCII, so positions in the letter string are line numbers.
    """

    def placed(b: Column) -> Column:
        start = F.regexp_instr(b["letters"], F.lit(first)) - 1
        return let(
            F.struct(b["text"].alias("text"), b["lines"].alias("lines"), b["letters"].alias("letters"), start.alias("start")),
            lambda p: F.when(p["start"] < 0, _unsplit(p["text"])).otherwise(
                let(
                    F.struct(
                        p["text"].alias("text"),
                        p["lines"].alias("lines"),
                        p["letters"].alias("letters"),
                        p["start"].alias("start"),
                        F.length(
                            F.regexp_extract(
                                F.substring(p["letters"], p["start"] + 1, F.length(p["letters"])), extent, 0
                            )
                        ).alias("extent"),
                    ),
                    build,
                )
            ),
        )

    return let(
        let(
            let(text, lambda t: F.struct(t.alias("text"), lines_of(t).alias("lines"))),
            lambda b: F.struct(
                b["text"].alias("text"),
                b["lines"].alias("lines"),
                signature(b["lines"], letter).alias("letters"),
            ),
        ),
        placed,
    )


def split_list(text: Column, options: StructureOptions = StructureOptions()) -> Column:
    """Split a list; an item is its line and all lines up to the next item."""

    def letter(line: Column) -> Column:
        return F.when(_is_item(line), F.lit("t")).otherwise(F.lit("o"))

    def build(b: Column) -> Column:
        items = runs(
            F.slice(b["lines"], b["start"] + 1, b["extent"]),
            lambda line, _: _is_item(line),
            "\n",
        )
        return let(
            strip(join_slice(b["lines"], F.lit(0), b["start"])),
            lambda heading: _parts(
                items, options.list_items_per_part, "Items", heading, F.lit(""), lambda rows: rows, F.lit("")
            ),
        )

    return _located(text, letter, "t", "^[to]+", build)


def split_nested(
    text: Column, options: StructureOptions = StructureOptions(), keep_rest: bool = True
) -> Column:
    """Split nested bullets; a group is a main bullet with its nested and blank lines.

    The block starts at the first main bullet with a nested line among the next four and
    ends at the first line of another kind. Part markers of an earlier split are skipped.
    """

    def unmarked(lines: Column) -> Column:
        return F.filter(lines, lambda line: ~_is(line, r"^\s*" + fv.PART_MARKER))

    def build(b: Column) -> Column:
        before = unmarked(F.slice(b["lines"], F.lit(1), b["start"]))
        inside = unmarked(F.slice(b["lines"], b["start"] + 1, b["extent"]))
        after = F.slice(
            b["lines"],
            b["start"] + b["extent"] + 1,
            F.size(b["lines"]) - b["start"] - b["extent"],
        )
        groups = runs(inside, lambda line, _: _is(line, fv.MAIN_BULLET_LINE), "\n")
        return let(
            let(
                before,
                lambda lines: F.struct(
                    strip(F.array_join(lines, "\n")).alias("heading"),
                    _name_of(_last(lines, F.size(lines)), any_text=False).alias("name"),
                ),
            ),
            lambda context: _parts(
                groups,
                options.nested_groups_per_part,
                "Groups",
                context["heading"],
                context["name"],
                lambda rows: rows,
                strip(F.array_join(after, "\n")) if keep_rest else F.lit(""),
            ),
        )

    return _located(text, _bullet_letter, "m[msbiw]{0,3}n", "^[mnibk]+", build)


def split_structures(
    text: Column, options: StructureOptions = StructureOptions(), keep_rest: bool = True
) -> Column:
    """Split the text by its kind: nested bullets first, then tables, then lists."""

    def dispatch(t: Column) -> Column:
        return let(
            profile(t, options)["kind"],
            lambda kind: F.when(kind == "nested", split_nested(t, options, keep_rest))
            .when(kind == "table", split_table(t, options, keep_rest))
            .when(kind == "list", split_list(t, options))
            .otherwise(_unsplit(t)),
        )

    return let(text, dispatch)


def explode_parts(df: DataFrame, parts: Column) -> DataFrame:
    """One row per part: adds part_no, n_parts, kind and text.

    The generator takes the expression itself. Over a named column Spark would add a filter on
    its size and, pushing that down, compute the parts once more for it.
    """
    counted = let(
        parts,
        lambda p: F.transform(
            p,
            lambda part: F.struct(
                F.size(p).alias("n_parts"), part["kind"].alias("kind"), part["text"].alias("text")
            ),
        ),
    )
    return df.select(*df.columns, F.posexplode(counted).alias("_no", "_part")).select(
        *df.columns, (F.col("_no") + 1).alias("part_no"), "_part.*"
    )
