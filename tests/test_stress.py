"""Large, broken or repetitive texts: every column function stays linear and keeps the JVM alive."""

import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.dialogue_json import dialogue_items
from corpusloom.functions.html import html_to_markdown
from corpusloom.functions.markdown import guide_title, heading_context, plain_text
from corpusloom.operators import cleaning, headings, sections, structures

HEADER = "### G Request Edit\nLast Edited on : May 1 Share\nCopy URL Facebook X\n"
TEXTS = {
    "one line": "word " * 60_000,
    "short lines": "a b\n" * 80_000,
    "blank lines": "x" + "\n" * 100_000 + "y",
    "spaces": "x" + " " * 300_000 + "y",
    "open brackets": "[a " * 30_000,
    "links": "[a](http://b) " * 20_000,
    "unclosed links": "[x](http://y)" + "[a](" * 250_000 + "\n](http",
    "brackets only": "[x](http://y)" + "[" * 1_000_000 + "\n](http",
    "unclosed images": "![x](http://y)" + "![a" * 330_000 + "\n](http",
    "open lists": "<ul><li>" * 100_000,
    "closed lists": "<ul><li>a</li></ul>" * 20_000,
    "ampersands": "&amp;&x" * 40_000,
    "link lines": "[a](http://b)\n" * 20_000,
    "headings": "## h\n" * 30_000,
    "underlined": "Title\n---\n" * 25_000,
    "rules": "---\n" * 60_000,
    "numbered": "1. a\n" * 40_000,
    "nested": "* a\n  * b\n" * 25_000,
    "pipes": "| a | b |\n" * 25_000,
    "stars": "*" * 150_000,
    "ticks": "`" * 150_000,
    "underscores": "_a " * 60_000,
    "sentences": "a. " * 60_000,
    "social lines": HEADER + "body\nShare\n" * 15_000,
    "linked images": HEADER + "[![Image 1](u)](v)\n" * 15_000,
    "spaced bullets": "\n\n* " * 30_000,
    "open tags": '<b><i><a href="x">' * 15_000,
    "angles": "<" * 100_000,
}
FUNCTIONS = {
    "plain_text": plain_text,
    "guide_title": lambda t: guide_title(F.lit(""), t),
    "heading_context": heading_context,
    "clean_header_footer": cleaning.clean_header_footer,
    "clean_intro_anchor": cleaning.clean_intro_anchor,
    "clean_title_suffix": cleaning.clean_title_suffix,
    "clean_default": cleaning.clean_default,
    "split_h3": headings.split_h3,
    "split_h2_h4": headings.split_h2_h4,
    "chunks_under_limit": lambda t: sections.chunks_under_limit(headings.split_generic(t)),
    "split_structures": structures.split_structures,
    "html_to_markdown": html_to_markdown,
    "dialogue_items": dialogue_items,
}


@pytest.fixture(scope="module")
def large(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "name string, t string").repartition(8, "name").cache()
    df.count()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name", FUNCTIONS)
def test_large_texts(large, name):
    started = time.time()
    found = large.select(FUNCTIONS[name](F.col("t")).alias("r"))
    found.write.format("noop").mode("overwrite").save()
    assert time.time() - started < 60
