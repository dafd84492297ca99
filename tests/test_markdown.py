"""HTML to markdown, titles, heading context, plain text."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.html import html_title, html_to_markdown
from corpusloom.functions.markdown import guide_title, heading_context, plain_text, plain_text_safe


def test_html_elements(each):
    html = (
        "<html><head><title>A &amp; B</title><style>p{}</style></head><body><nav><a href='/'>x</a></nav>"
        "<!-- no --><h2 class='t'>Head</h2><p>One <b>bold</b> <em>it</em> <code>c()</code><br>two &copy; &#233;&#8217;</p>"
        '<ul><li>a</li><li><a href="/u">b</a></li></ul><hr><img src="s.png" alt="pic">'
        "<table><tr><th>H1</th><th>H2</th></tr><tr><td>1</td><td> 2 </td></tr></table>"
        "<pre>x = 1\n  y &lt; 2</pre><footer>bye</footer></body></html>"
    )
    assert each(html_title, html) == ["A & B"]
    assert each(html_to_markdown, html)[0] == (
        "## Head\n\nOne **bold** _it_ `c()`\ntwo © é’\n\n* a\n* [b](/u)\n\n***\n\n![pic](s.png)\n\n"
        "| H1 | H2 |\n| --- | --- |\n| 1 | 2 |\n\n```\nx = 1\n  y < 2\n```"
    )
    assert each(html_to_markdown, "", "plain", "<p>only</p>", "<pre> </pre>", "a &#5; &#xyz") == [
        "", "plain", "only", "", "a &#5; &#xyz",
    ]


def test_guide_title_priority_is_by_form(each):
    title = lambda fetched: lambda t: guide_title(F.lit(fetched), t)
    text = "### three\n## two\n# one\nTitle: t"
    assert each(title(""), text, "## two\n### three", "Title: t\nx", "\n first \nsecond", "#tag\nx", "") == [
        "one", "two", "t", "first", "#tag", "",
    ]
    assert each(title(" Fetched "), text) == ["Fetched"]


def test_heading_context(each):
    assert each(
        heading_context,
        "# One\nx\n### Three\nTwo\n---\n#### Four",
        "A\n===\nB\n----",
        "no heading",
        "x\n\n---\ny",
        "#tag line",
    ) == [
        "# One\n    ### Three\n  ## Two", "# A\n  ## B", "Guide Section", "Guide Section", "# tag line",
    ]


def test_plain_text_forms(each):
    cases = {
        "```\ncode\n```\nafter": "after",
        "use `x` and ![alt](u) and [link](v)": "use x and alt and link",
        "**b** __c__ *d* _e_": "b c d e",
        "## Head\ntext": "Head\ntext",
        "Title\n=====\ntext": "Title\ntext",
        "1. one\n2. two": "- one\n- two",
        "- one\n+ two": "- one\n- two",
        "| a | b |\n|---|---|\n| 1 |  | 2 |": "a - b\n1 - 2",
        "| a | b |\n|:---|---|\n": "a - b\n:--- - ---",
        r"a\_b \[c\]": "a_b [c]",
        "x\n\n-----\n\ny": "x\n\ny",
        # Emphasis takes two of the three stars; the third is then a bullet.
        "x\n\n***\n\ny": "x\n- y",
        "a  \t b\n\n\n\nc": "a b\n\nc",
        "Image 12\nRequest Edit\nok": "ok",
        # Emphasis pairs the stars of bullets before lists are looked at.
        "* a\n* b\n* c": "a\nb\n- c",
        "": "",
    }
    got = dict(zip(cases, each(plain_text, *cases)))
    assert got == cases


def test_safe_plain_text_keeps_bullets_and_names(each):
    cases = {
        "* a\n* b\n* c": "- a\n- b\n- c",
        "**b** __c__ *d* _e_ _f_": "b c d e f",
        "snake_case_name and 2 * 3 * 4": "snake_case_name and 2 * 3 * 4",
        "*over\nlines*": "*over\nlines*",
        "| a | b |\n|:---|---:|\n| 1 | 2 |": "a - b\n1 - 2",
        "1. **one**\n2. two": "- one\n- two",
        "": "",
    }
    assert dict(zip(cases, each(plain_text_safe, *cases))) == cases


def test_long_and_regular_texts_do_not_break_the_regex_engine(each):
    big = [
        "word " * 200_000,
        "| " + "--- | " * 20_000,
        "\n" * 20_000 + "x",
        "* a\n" * 50_000,
        "[" * 5_000 + "x",
        "<p>" * 50_000 + "x",
    ]
    assert len(each(plain_text, *big)) == len(big)
    assert each(html_to_markdown, *big)[-1] == "x"


@pytest.mark.parametrize("html, markdown", [
    ("<ul><li>a<ul><li>b</li><li>c<ol><li>x<li>y</ol></li></ul></li><li>d</li></ul><p>end</p>",
     "* a\n  * b\n  * c\n    1. x\n    2. y\n* d\n\nend"),
    ("<ol><li>one</li><li>two <b>bold</b></li></ol>", "1. one\n2. two **bold**"),
    ("<a href='u'>t</a> <a href=v>w</a> <img src=i.png alt='q z'>", "[t](u) [w](v) ![q z](i.png)"),
    ("&eacute;&#x27;&#0000039;&#1114111;&amp;lt; &bogus; &nbsp;x &#65 & b&copy;", "é\'\'\U0010ffff&lt; &bogus; x &#65 & b©"),
    ("<ul><li><p>para</p></li></ul>", "* para"),
    ("<ul><li>unclosed", "* unclosed"),
])
def test_html_forms(each, html, markdown):
    assert each(html_to_markdown, html) == [markdown]


def test_nested_html_lists_are_found_as_nested(spark):
    from pyspark.sql import functions as F

    from corpusloom.operators.structures import profile

    html = "<ul>" + "".join(f"<li>m{k}<ul><li>a</li><li>b</li></ul></li>" for k in range(20)) + "</ul>"
    df = spark.createDataFrame([(html,)], "html string").select(html_to_markdown(F.col("html")).alias("c"))
    assert "nested" in str(df.select(profile(F.col("c")).alias("p")).first())


def test_skipped_rewrites_would_change_nothing(each):
    """Rewrites that are chosen by the names of elements give what all of them in turn give, also for broken and nested marks."""
    import random

    from corpusloom.functions import html

    marks = [
        "<b>", "</b>", "<I>", "</i >", "<strong x=1>", "</strong>", "<code>", "</code>", "<a href='u'>", "</A>", "<h1>", "<H2 c=d>", "</h2>",
        "<h6", "<li>", "<br/>", "<hr>", "<img src=x>", "<img alt='y' src=x>", "<p>", "</div>", "<x>", "<", ">", "<>", "<bx>", "word", " ", "\n", "_",
    ]
    draw = random.Random(7)
    texts = ["".join(draw.choices(marks, k=draw.randint(1, 14))) for _ in range(1_500)]
    in_turn = each(lambda t: html._rewritten(t, html.TAG_REWRITES), *texts)
    assert each(html._without_tags, *texts) == in_turn


def test_blanks_and_lists_with_and_without_ends(each):
    from corpusloom.functions import html

    texts = ["a  b\t c \n\n d", " ", "\x01\x02 x", "a b", "\x0b\x0c\r", "a  b", "  a\n"]
    assert each(lambda t: F.regexp_replace(t, html.BLANKS, " "), *texts) == each(lambda t: F.regexp_replace(t, r"[\s\x01-\x03]+", " "), *texts)
    kinds = [["ul", "li", "/u"], ["ul", "ol", "/o"], ["/u", "ul"], ["ul", "/u", "/u", "ol"], []]
    marked = lambda t: html._marked_closed(
        F.filter(F.split(t, ","), lambda k: k != ""), lambda k: k.isin("ul", "ol"), lambda k: k.isin("/u", "/o")
    )
    found = each(marked, *[",".join(k) for k in kinds])
    opened = [[u["closed"] for u in units if u["tag"] in ("ul", "ol")] for units in found]
    assert opened == [[True], [False, True], [False], [True, False], []]


def test_long_references(each):
    zeros = "&#" + "0" * 60 + "65;x &#x" + "0" * 60 + "41;y &" + "n" * 60 + ";z &CounterClockwiseContourIntegral; a" + " b" * 50
    assert each(html_to_markdown, zeros) == ["Ax Ay &" + "n" * 60 + ";z ∳ a" + " b" * 50]
