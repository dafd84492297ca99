"""Site cleaning, dates, routing."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.cleaning import (
    clean_by_url,
    clean_default,
    clean_header_footer,
    clean_intro_anchor,
    clean_title_suffix,
    extract_date,
)
from corpusloom.operators.routing import route, route_by_rule_table, route_by_rules

HEAD = "menu\n### My Guide Request Edit\nLast Edited on : May 1, 2024 Share\nCopy URL Facebook X\n\n"


def test_header_footer(each):
    cases = {
        "  no header \n": "no header",
        HEAD + "body": "### My Guide\n\nbody",
        HEAD + "a\n\n\n\nb\n__the content of the game guide may differ from the actual game content.\nz": "### My Guide\n\na\n\nb",
        HEAD + "a\n### Request Edit now\nz": "### My Guide\n\na",
        HEAD + "a\n### Request Edits\nz": "### My Guide\n\na\n### Request Edits\nz",
        HEAD + "a\nShare\nb": "### My Guide\n\na\nShare\nb",
        # Two social lines need not be next to each other.
        HEAD + "a\nShare\nb\n  discord me\nz": "### My Guide\n\na",
        # An earlier cut can leave one social line, which no longer counts.
        HEAD + "a\nShare\nSend request to update\nTwitter": "### My Guide\n\na\nShare",
        HEAD + "a\n[x](http://a) t\n[y](https://b)\nz": "### My Guide\n\na\n[x](http://a) t\n[y](https://b)\nz",
        HEAD + "a\n[x](http://a) t\n[y](https://b)\nq\n[z](https://c)\nz": "### My Guide\n\na",
        HEAD + "a\n[![Image 3: PEGI](u)](v)\nz": "### My Guide\n\na",
        # The rating may follow on a later line; the cut starts at the first linked image.
        HEAD + "a 😀\n[![Image 1](u)](v)\nmid\n[![Image 2: PEGI](u)](v)": "### My Guide\n\na 😀",
        HEAD + "a\n[![Image 1](u)](v)\nmid": "### My Guide\n\na\n[![Image 1](u)](v)\nmid",
    }
    assert dict(zip(cases, each(clean_header_footer, *cases))) == cases


def test_intro_anchor(each):
    cases = {
        "": "",
        "Title: My Guide - BDFoundry\nDescription: d\nSkip to content\nbody": "# My Guide\n\nbody\n",
        "Other - BDFoundry\nx\n## Introduction\nbody": "# Other\n\n## Introduction\nbody\n",
        "x\n### Introduction\nb\nIntroduction\n---\nc": "# Unknown\n\nIntroduction\n---\nc\n",
        "a\n**Last Updated:** May | x\nmore\n# H\nb": "# Unknown\n\na\n# H\nb\n",
        "a\nYou are here: x\ny": "# Unknown\n\na\n",
        "a\n#### Quick Links\n* x\n* y\n### Next\nb": "# Unknown\n\na\n### Next\nb\n",
        "a\nThe content of the game guide may differ from the actual game content z": "# Unknown\n\na\n",
        "a\nthe content of the game guide may differ from the actual game content": (
            "# Unknown\n\na\nthe content of the game guide may differ from the actual game content\n"
        ),
        "a\n[By Me](u) x\nb": "# Unknown\n\na\n",
        "a\n### check these out before you go!\nb\n[By Me](u)": "# Unknown\n\na\n",
    }
    assert dict(zip(cases, each(clean_intro_anchor, *cases))) == cases


def test_title_suffix(each):
    cases = {
        "": "",
        "My G | Guide | Garmoth.com - BDO Companion\n![i](u) By Me\nbody": "# My G\n\nbody\n",
        "x\n1.  Introduction\nbody\n2. Next": "# Unknown\n\n1.  Introduction\nbody\n2. Next\n",
        "a\nb\n**Wrong? let us  know!** now\nc": "# Unknown\n\na\nb\n",
        # The closing line alone is cut, not the text line before it.
        "a\nb\n\nLet us know!\nc": "# Unknown\n\na\nb\n",
    }
    assert dict(zip(cases, each(clean_title_suffix, *cases))) == cases


def test_default_and_registry(spark, each):
    assert each(clean_default, "a [b](c) d\n\n\ne ![i](u)\n", "") == ["a  d\ne !", ""]
    rows = [
        ("https://garmoth.com/x?from=playblackdesert.com", "a\nLet us know!"),
        ("https://www.playblackdesert.com/", HEAD + "b"),
        ("https://x.org/", "[l](u) c"),
    ]
    df = spark.createDataFrame(rows, "url string, content string").coalesce(1)
    got = [r[0] for r in df.select(clean_by_url(F.col("content"), F.col("url"))).collect()]
    assert got == ["# Unknown\n\na\n", "### My Guide\n\nb", "c"]
    own = {"x.org": lambda c: F.upper(c)}
    assert df.select(clean_by_url(F.col("content"), F.col("url"), own)).collect()[2][0] == "[L](U) C"


def test_dates(spark):
    rows = [
        ("https://playblackdesert.com/", "Last edited ON : May 1, 2024  Share x", "May 1, 2024"),
        ("https://blackdesertfoundry.com/", "a\n**Last Updated:** Jun 2, 2024 | by", "Jun 2, 2024"),
        ("https://blackdesertfoundry.com/", "**last updated:** Jul 3\nx", "Jul 3"),
        ("https://garmoth.com/", "x Updated: Aug 4 | y", "Aug 4"),
        ("https://garmoth.com/", "none", ""),
        ("https://other.com/", "Updated: Aug 4", ""),
    ]
    df = spark.createDataFrame(rows, "url string, content string, want string")
    for r in df.select("want", extract_date(F.col("content"), F.col("url")).alias("got")).collect():
        assert r["got"] == r["want"]


def test_routing(spark, each):
    assert each(lambda u: route(u, ["b.com", "a.com"]), "http://a.com/b.com", "http://a.com", "x") == [
        "b.com", "a.com", "default",
    ]
    urls = spark.createDataFrame([("http://a.com/b.com",), ("x",)], "url string")
    rules = [("clean", 2, "a.com", "two"), ("clean", 1, "b.com", "one"), ("clean", 1, "c.com", "none")]
    routed = route_by_rules(urls, rules).collect()
    assert sorted(r["clean_strategy"] for r in routed) == ["default", "one"]


def test_rule_tables_of_any_size(spark):
    """A hundred thousand rules give what literal branches give, without a join."""
    import random

    rng = random.Random(3)
    names = ["".join(rng.choices("abcdé.", k=rng.randint(1, 4))) for _ in range(400)]
    rules = [(rng.choice("xy"), rng.randint(0, 5), rng.choice(names), f"s{k % 9}") for k in range(300)]
    urls = spark.createDataFrame([(k, "".join(rng.choices("abcdé./", k=12))) for k in range(200)] + [(900, None), (901, "")], "k int, url string")
    table = spark.createDataFrame(rules + [("x", 9, None, "s"), (None, 9, "a", "s")], "stage string, priority int, domain string, strategy string")
    want = {r.k: r for r in route_by_rules(urls, sorted(set(rules))).collect()}
    routed = route_by_rule_table(urls, table)
    assert "Join" not in routed._jdf.queryExecution().toString()
    assert {r.k: r for r in routed.collect()} == want

    many = spark.range(100_000).selectExpr("'x' AS stage", "CAST(1 + id % 50 AS int) AS priority", "concat('q', id, '/') AS domain", "concat('s', id) AS strategy")
    asked = spark.createDataFrame([(f"https://q{k}/q{k + 1}/z",) for k in range(0, 99_000, 97)], "url string")
    for r in route_by_rule_table(asked, many).collect():
        k = int(r.url.split("/q")[1].split("/")[0])
        best = min((k, k + 1), key=lambda i: (1 + i % 50, f"q{i}/"))
        assert r.x_strategy == f"s{best}"
    assert route_by_rule_table(urls, many.limit(0)).columns == urls.columns
    every = route_by_rule_table(urls, spark.createDataFrame([("x", 1, "", "all")], table.schema)).collect()
    assert {r.x_strategy for r in every if r.url is not None} == {"all"} and [r.x_strategy for r in every if r.url is None] == ["default"]
    with pytest.raises(ValueError, match="more than 10"):
        route_by_rule_table(urls, many, most_rules=10)
