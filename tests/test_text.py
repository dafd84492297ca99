"""Text helpers against Python's own string methods."""

import time

from pyspark.sql import functions as F

from corpusloom.functions.text import (
    all_lines,
    at_least_words,
    buckets,
    is_blank,
    runs,
    strip,
    tokens,
    words,
)

NASTY = [
    "", " ", "a", " a b ", " x y　", "\x1cone\x1dtwo\x1f", "​zero width",
    "tab\tand\x0bmore\x0c", "\x85next", "é è ü ß", "emoji 😀 x", "line\r\nline\rline\n",
    "\x00nul \x7fdel \x80pad", "a" * 1000 + " " * 1000 + "b", "﻿bom word", "᠎ mongol",
]


def test_strip_and_words_match_python(each):
    assert each(strip, *NASTY) == [t.strip() for t in NASTY]
    assert each(words, *NASTY) == [len(t.split()) for t in NASTY]


def test_tokens_are_whole_words_times_1_3(each):
    texts = ["w " * n for n in (0, 1, 2, 3, 7, 10, 99, 1000)]
    assert each(tokens, *texts) == [int(len(t.split()) * 1.3) for t in texts]


def test_at_least_words(each):
    texts = ["", "one", "a b", "a  b c", " a b c d ", "é è ü"]
    for n in (1, 2, 3):
        assert each(lambda t: at_least_words(t, n), *texts) == [len(t.split()) >= n for t in texts]


def test_at_least_words_of_long_texts(each):
    """Thousands of words are read without a recursion for each."""
    texts = ["w \n" * 49_999, "w\u00a0" * 50_000]
    assert each(lambda t: at_least_words(t, 50_000), *texts) == [False, True]


def test_is_blank(each):
    assert each(is_blank, *NASTY) == [t.strip() == "" for t in NASTY]


def test_all_lines(each):
    texts = ["a\r\nb\rc\nd", "x\x0by\x1cz w\x85v", "one"]
    assert each(all_lines, *texts) == [t.splitlines() for t in texts]


def test_runs_and_buckets(each):
    letters = lambda t: F.filter(F.split(t, ""), lambda c: c != "")
    cut = lambda t: runs(letters(t), lambda c, _: c == "x", "")
    assert each(cut, "abxcxd", "x", "ab", "") == [["ab", "xc", "xd"], ["x"], ["ab"], []]
    by_two = lambda t: F.transform(buckets(letters(t), 2), lambda b: F.array_join(b, ""))
    assert each(by_two, "abcde", "ab", "") == [["ab", "cd", "e"], ["ab"], []]


def test_runs_with_the_mark_inside(each):
    texts = ["a|b|+c|+d", "a\x01b|+c\x01|d", "+", "\x01", ""]
    for null in (None, "c"):
        def joined(t):
            units = F.transform(F.split(t, r"\|"), lambda u: F.nullif(u, F.lit(null)) if null else u)
            return F.array_join(runs(units, lambda u, i: u.startswith("+"), "-"), "/")

        assert each(joined, *texts) == ["a-b/+c/+d", "a\x01b/+c\x01-d", "+", "\x01", ""]


def test_runs_cost_grows_with_the_array(spark):
    """Ten times the runs take far less than a hundred times as long."""

    def seconds(n: int) -> float:
        units = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat(i.cast("string"), F.lit(" of the units")))
        rows = spark.range(0, 8, 1, 8).select((F.lit(n) + F.col("id")).cast("int").alias("n"))
        found = rows.select(F.size(runs(units, lambda u, i: F.lit(True), " ")).alias("size"), "n")
        began = time.monotonic()
        assert all(r["size"] == r["n"] for r in found.collect())
        return time.monotonic() - began

    seconds(3_000)
    assert seconds(30_000) < 20 * max(seconds(3_000), 0.25)
