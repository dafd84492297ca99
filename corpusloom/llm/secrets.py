"""Secret scan by sliding-window Shannon entropy, with SQL functions only.

Base patterns (assignments, access keys, hex runs) give spans as they are. They are blanked out, kind by kind, and in what is left
every run of at least `window` characters of a token alphabet is a candidate. A window slides over it with a count per
character: the one that enters and the one that leaves change one count each, and the sum of c * log2(c) by what these
two counts add to it, so no step looks at the other characters in the window. The candidate is a secret if any window's entropy reaches
the bound of its character class. The allow-list suppresses whole shapes (UUIDs, words joined by marks, plain numbers). Placeholders
(example, changeme, runs of one character) suppress a candidate of up to twice the window that holds one; from a longer one they
are taken out, and what is left is judged.

All places are code points, ends exclusive. A text is one row's work, linear in its length and its matches; nothing is shuffled.

Defined cases: NULL and empty texts have no spans. Repeated rows give repeated results. Spans are ordered by start, then
assign, access, hex, entropy. Other columns pass through unread; earlier columns `_base` and `_spans` are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import let
from corpusloom.llm.spans import blanked, matches

# The base patterns and their least lengths.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"

# Classes of candidates: what their characters are, and the least entropy in bits a character.
CLASSES = (
    ("hex", r"\A[0-9a-fA-F]++\z", 3.0),
    ("letters", r"\A[A-Za-z]++\z", 4.1),
    ("mixed", r"\A[A-Za-z0-9+/_=-]++\z", 3.8),
)
ALLOWED = (
    r"\A[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}\z",  # UUID
    r"\A[0-9+/_=-]++\z",  # numbers, dates, rules
    r"\A/?[A-Za-z]{1,15}(?:[-_/+=][A-Za-z]{1,15}){2,200}+/?\z",  # joined words, paths
)
PLACEHOLDERS = r"(?i)example|placeholder|changeme|(?:x{6,}|0{8,}|a{8,})"
# Characters of candidates lie between these two, so that a count per character is a string of fixed length.
_FIRST, _LAST = "+", "z"
_PLACES = ord(_LAST) - ord(_FIRST) + 1
# A count is kept as a character, from "0" on.
_ZERO = ord("0")


@dataclass(frozen=True)
class SecretOptions:
    window: int = 20
    classes: tuple = CLASSES
    allowed: tuple = ALLOWED
    placeholders: str = PLACEHOLDERS

    def __post_init__(self):
        if not 2 <= self.window <= 70:
            raise ValueError("a window has 2 to 70 characters")


def _weighted(count: Column, window: int) -> Column:
    """count * log2(count), from a table."""
    table = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)])
    return F.get(table, count)


def peak_entropy(candidate: Column, window: int) -> Column:
    """The largest entropy of any window of a candidate, in bits a character; 0 if it is shorter than one."""

    def place(char: Column) -> Column:
        return F.ascii(char) - (ord(_FIRST) - 1)

    def count(counts: Column, char: Column) -> Column:
        return F.ascii(F.substring(counts, place(char), F.lit(1))) - _ZERO

    def put(counts: Column, char: Column, number: Column) -> Column:
        return F.overlay(counts, F.chr(number + _ZERO), place(char), F.lit(1))

    def walk(chars: Column) -> Column:
        def step(state: Column, char: Column) -> Column:
            def enters(n: Column) -> Column:
                total = state["total"] + _weighted(n + 1, window) - _weighted(n, window)
                return F.struct(put(state["counts"], char, n + 1).alias("counts"), total.alias("total"))

            def leaves(now: Column) -> Column:
                gone = F.get(chars, state["at"] - window)

                def without(n: Column) -> Column:
                    total = now["total"] + _weighted(n - 1, window) - _weighted(n, window)
                    return F.struct(put(now["counts"], gone, n - 1).alias("counts"), total.alias("total"))

                return F.when(state["at"] >= window, let(count(now["counts"], gone), without)).otherwise(now)

            def noted(now: Column) -> Column:
                entropy = F.when(state["at"] >= window - 1, math.log2(window) - now["total"] / window).otherwise(0.0)
                return F.struct(
                    now["counts"].alias("counts"),
                    now["total"].alias("total"),
                    F.greatest(state["peak"], entropy).alias("peak"),
                    (state["at"] + 1).alias("at"),
                )

            return let(let(let(count(state["counts"], char), enters), leaves), noted)

        zero = F.struct(
            F.lit(chr(_ZERO) * _PLACES).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("peak"), F.lit(0).alias("at")
        )
        return F.aggregate(chars, zero, step)["peak"]

    return let(F.split(candidate, ""), walk)


def _is_secret(candidate: Column, options: SecretOptions) -> Column:
    bound = F.lit(None).cast("double")
    for _, shape, least in reversed(options.classes):
        bound = F.when(F.rlike(candidate, F.lit(shape)), F.lit(least)).otherwise(bound)
    allowed = F.lit(False)
    for shape in options.allowed:
        allowed = allowed | F.rlike(candidate, F.lit(shape))
    short = F.length(candidate) <= 2 * options.window
    allowed = allowed | (short & F.rlike(candidate, F.lit(options.placeholders)))
    judged = F.when(short, candidate).otherwise(F.regexp_replace(candidate, options.placeholders, ""))
    return F.when(allowed, False).otherwise(peak_entropy(judged, options.window) >= bound)


def _long_value(hit: Column) -> Column:
    return F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_LEAST


def _any(hit: Column) -> Column:
    return hit.isNotNull()


def base_spans(text: Column) -> Column:
    assign = matches(text, ASSIGN, "assign", 0, _long_value)
    assign = F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), assign)
    access = F.when(F.contains(text, F.lit("AKIA")), matches(text, ACCESS, "access", 1, _any))
    hexes = matches(text, HEX, "hex", 2, _any)
    none = F.slice(hexes, 1, 0)
    return F.concat(F.coalesce(assign, none), F.coalesce(access, none), hexes)


def entropy_spans(text: Column, options: SecretOptions = SecretOptions()) -> Column:
    """Candidates in what the base patterns leave."""
    token = "[A-Za-z0-9+/_=-]"
    pattern = rf"(?<!{token}){token}{{{options.window},}}+"
    for base, keep in ((ASSIGN, _long_value), (ACCESS, _any), (HEX, _any)):
        text = let(text, lambda t, base=base, keep=keep: blanked(t, base, keep))
    return let(text, lambda t: matches(t, pattern, "entropy", 3, lambda hit: _is_secret(hit, options)))


def with_secrets(df: DataFrame, text: str = "text", options: SecretOptions = SecretOptions()) -> DataFrame:
    """`df` with `_base` and `_spans`, arrays of (start, rank, end, kind) ordered by start and rank."""
    given = F.coalesce(F.col(text), F.lit(""))

    def by_place(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"]))

    found = df.withColumn("_base", F.sort_array(by_place(base_spans(given))))
    return found.withColumn("_spans", F.sort_array(F.concat("_base", by_place(entropy_spans(given, options)))))
