"""Matches of a pattern with their places, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import let, notes

SPAN = "array<struct<start:int,end:int,rank:int,kind:string>>"
NO_SPANS = f"cast(array() as {SPAN})"


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut at its matches: ARRAY<STRUCT<gap, hit>>, the last hit NULL."""
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("hit"))


def matches(text: Column, pattern: str, kind: str, rank: int, keep: Callable[[Column], Column]) -> Column:
    """Leftmost matches that do not overlap, in code points, less those that fail `keep`.

    The text is cut at the matches, so places are running sums of lengths; one walk notes them, in time linear in the text and
    its matches. A text without a match costs one search.
    """

    def step(at: Column, piece: Column):
        start = at + F.length(piece["gap"])
        return start.cast("string"), start + F.coalesce(F.length(piece["hit"]), F.lit(0))

    def placed(bound: Column) -> Column:
        starts = notes(bound, "int", "0", step)

        def spans(b: Column) -> Column:
            all_spans = F.transform(
                b["pieces"],
                lambda piece, i: F.when(
                    F.coalesce(keep(piece["hit"]), F.lit(False)),
                    let(
                        F.get(b["starts"], i).cast("int"),
                        lambda start: F.struct(
                            start.alias("start"),
                            (start + F.length(piece["hit"])).alias("end"),
                            F.lit(rank).alias("rank"),
                            F.lit(kind).alias("kind"),
                        ),
                    ),
                ),
            )
            return F.filter(all_spans, lambda s: s.isNotNull())

        return let(F.struct(bound.alias("pieces"), starts.alias("starts")), spans)

    found = let(_pieces(text, pattern), placed)
    return F.when(F.rlike(text, F.lit(pattern)), found).otherwise(F.expr(NO_SPANS))


def blanked(text: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """The text with as many blanks in place of each match that passes `keep`, so that places stay."""

    def piece(p: Column) -> Column:
        hit = F.coalesce(p["hit"], F.lit(""))
        held = F.when(F.coalesce(keep(p["hit"]), F.lit(False)), F.repeat(F.lit(" "), F.length(hit))).otherwise(hit)
        return F.concat(p["gap"], held)

    whole = F.array_join(F.transform(_pieces(text, pattern), piece), "")
    return F.when(F.rlike(text, F.lit(pattern)), whole).otherwise(text)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
