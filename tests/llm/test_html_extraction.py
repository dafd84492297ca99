import itertools
import re
from html import unescape

import numpy as np
import pytest

from corpusloom.llm.html_extraction import PageOptions, common_lines, with_main_text
from corpusloom.llm.page_blocks import ARTICLE, CHROME, OPEN, blocks_of


def lcs(a, b):
    """Length of the longest common subsequence, cell by cell."""
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


@pytest.mark.parametrize("table_bytes", [1 << 20, 200, 1])
def test_alignment_is_a_longest_common_subsequence(table_bytes):
    draw = np.random.default_rng(3)
    for n, m, kinds in itertools.product((0, 1, 7, 40, 90), (0, 1, 8, 70), (1, 2, 5, 60)):
        a, b = draw.integers(0, kinds, n).tolist(), draw.integers(0, kinds, m).tolist()
        pairs = common_lines(a, b, table_bytes)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
        assert len(pairs) == lcs(a, b)


def zones(html):
    return [(b.text, b.zone) for b in blocks_of(html)]


@pytest.mark.parametrize(
    "html, want",
    [
        (None, []),
        ("", []),
        ("  \n ", []),
        ("plain text", [("plain text", OPEN)]),
        ("<p>a<p>b<br>c", [("a", OPEN), ("b c", OPEN)]),
        ("<article><p><b>One.<br><p>Two</p></article>x", [("One.", ARTICLE), ("Two", ARTICLE), ("x", OPEN)]),
        ("<nav><ul><li><a href='/'>N</a></ul></nav><main>t</main>", [("N", CHROME), ("t", ARTICLE)]),
        ("<p>a &lt;b&gt; &amp;amp; &copy &am &#233;&nbsp; z</p>", [("a <b> &amp; © &am é z", OPEN)]),
        ('<script>var t="</p>";</script><p>x</p><style>p{}</style>', [("x", OPEN)]),
        ("<SCRIPT>if (a</b>) x</SCRIPT ><p>y", [("y", OPEN)]),
        ("<head><title>T</title><p>x</p>", [("x", OPEN)]),
        ("<p>1 < 2 <3</p><!-- <p>no</p> -->z<!-- open", [("1 < 2 <3", OPEN), ("z", OPEN)]),
        ('<article><h1>T</h1><p>x</p><div class="ad">buy</div><p>y</article>',
         [("T", ARTICLE), ("x", ARTICLE), ("buy", CHROME), ("y", ARTICLE)]),
        ('<article><header><h1>T</h1></header><p>x<aside>s</aside>y<form>f</form><footer>g</footer></article>',
         [("T", ARTICLE), ("x", ARTICLE), ("s", CHROME), ("y", ARTICLE), ("f", CHROME), ("g", CHROME)]),
        ('<div id="comments"><article class="comment"><p>first!</p></article></div>', [("first!", CHROME)]),
        ('<div class="entry-content has-sidebar"><p>t</p></div><div class="cookieNotice">c</div>',
         [("t", ARTICLE), ("c", CHROME)]),
        ("<form><div><article>t</article></div></form>", [("t", ARTICLE)]),
        ("<ul><li><a href=a>A</a><li><a href=b>B</a></ul><ul><li>c<li><a>d</a></ul>",
         [("A", CHROME), ("B", CHROME), ("c", OPEN), ("d", OPEN)]),
        ('<p hidden>h</p><p style="display: none">i</p><p data-hidden-x="1">j</p>', [("h", CHROME), ("i", CHROME), ("j", OPEN)]),
        ("<article><div>a</section>b</span>c</div>d</article>", [("a", ARTICLE), ("bc", ARTICLE), ("d", ARTICLE)]),
        ('<article><h2 id="related-work">Related</h2><p id="notice">x <span class="hljs-comment"># y</span> '
         '<a class="ad">buy</a><p class="notice">n</article>',
         [("Related", ARTICLE), ("x # y", ARTICLE), ("buy", CHROME), ("n", CHROME)]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", [("a", OPEN), ("b", OPEN), ("c", OPEN)]),
        # A tag whose quote does not end is over at the next bracket, so no text is lost.
        ('<p title="a > b">x</p><a href="q>text', [("x", OPEN), ("text", OPEN)]),
        ("<p>x</p><a href=q", [("x", OPEN)]),
    ],
)
def test_blocks(html, want):
    assert zones(html) == want


def test_long_and_deep_pages_take_linear_time():
    assert len(blocks_of("<p>x" * 100_000)) == 100_000
    assert zones("<div>" * 50_000 + "x" + "</div>" * 50_000) == [("x", OPEN)]
    assert zones("<article>" + "<b>" * 20_000 + "x</section></i>" * 3 + "</article>")[0] == ("xxx"[:1], ARTICLE)
    assert blocks_of("<" * 200_000)[0].text == "<" * 200_000


SCHEMA = "page_id bigint, url string, html string, text int, page_host string, shared string, digest string"


def ran(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "h", "s", "d") for r in rows], SCHEMA).repartition(3)
    found = with_main_text(df, PageOptions(**options))
    assert {"page_host", "shared", "digest"} < set(found.columns) and "html" not in found.columns
    return sorted(((r.page_id, r.text, r.n_chars) for r in found.collect()), key=repr)


def site(k, extra=""):
    return (
        f"<body><div><div>Acme News</div><div>Home of news {extra}</div></div><div><p>Story {k} begins.</p>"
        f"<p>It goes on, number {k}, for a while longer than that.</p></div><div>All rights reserved</div></body>"
    )


def test_lines_shared_with_the_nearest_url_go(spark):
    rows = [(k, f"http://a.org/x/{k:03}", site(k)) for k in range(150)]
    rows += [(500, "http://A.org/x/149b?q=1", site(500)), (501, "http://b.org/x/1", site(501)), (502, None, site(502))]
    found = {i: text for i, text, _ in ran(spark, rows, stretch=16)}
    for k in (*range(150), 500):
        assert found[k] == f"Story {k} begins.\nIt goes on, number {k}, for a while longer than that."
    # A page without a neighbour on its host keeps its open lines.
    assert found[501].startswith("Acme News\nHome of news\nStory 501") and found[502].startswith("Acme News")


def test_copies_and_shared_passages_of_articles_stay(spark):
    page = "<nav>menu {0}</nav><article><h1>Same</h1><p>Shared passage.</p><p>Own {1}</p></article><footer>f</footer>"
    rows = [(k, f"http://a.org/{k}", page.format(k, k % 5)) for k in range(60)]
    rows += [(100 + k, "http://a.org/copy", site(7)) for k in range(40)]
    rows += [(200, "http://a.org/copz", site(8)), (7, "http://a.org/7", page.format(7, 2))]
    found = ran(spark, rows)
    for i, text, n in found:
        assert n == len(text)
        if i < 100:
            assert text == f"Same\nShared passage.\nOwn {i % 5}"
        else:
            assert text.startswith("Story"), text


def test_open_title_before_an_article(spark):
    html = "<body><h1>Title</h1><p>promo</p><article><p>a</p></article><p>after</p></body>"
    assert ran(spark, [(1, "http://a.org/1", html)]) == [(1, "Title\na", 7)]


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [(1, "", ""), (1, "", ""), (2, "no url", "<p>x"), (3, "http:///p", "y")]])
def test_empty_and_null_pages(spark, rows):
    want = sorted([(i, {2: "x", 3: "y"}.get(i, ""), 1 if i in (2, 3) else 0) for i, _, _ in rows], key=repr)
    assert ran(spark, rows) == want


def test_given_pages_against_a_plain_reading(spark):
    """The given pages have one article each, of headings and paragraphs whose only other tags are b and br."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in with_main_text(df).collect()}
    for r in df.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        blocks = re.split(r"</?(?:h1|p)>", article)
        lines = [" ".join(unescape(re.sub(r"</?(?:b|br)>", " ", b)).split()) for b in blocks]
        assert found[r.page_id] == "\n".join(line for line in lines if line)
