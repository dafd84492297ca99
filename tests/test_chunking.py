"""Heading cuts, recombining, orphans, oversized chunks."""

from pyspark.sql import functions as F

from corpusloom import ChunkOptions
from corpusloom.operators import headings, sections


def test_split_h3(each):
    cases = {
        "Intro\n\n### A\nbody\nTitle\n-----\nmore": ["Intro", "### A\nbody", "Title\n-----\nmore"],
        "## no cut\n#### no cut": ["## no cut\n#### no cut"],
        "### A\n---\nx": ["### A\n---\nx"],
        "É title\n---\nx": ["É title\n---\nx"],
        "a\n--- \nb": ["a\n--- \nb"],
        " \n ": [],
        "": [],
    }
    assert dict(zip(cases, each(headings.split_h3, *cases))) == cases


def test_split_h2_h4(each):
    long = "word " * 30
    cases = {
        "short\n\n## A\nx\n##### B\ny": ["short\n\n## A\nx\n##### B\ny"],
        long + "\n## A\nx\n#### B\ny": [long.strip(), "## A\nx", "#### B\ny"],
        "# Top\nx\n## A\ny": ["# Top\nx", "## A\ny"],
        "Title\n--- \nx\nT2\n--\ny": ["Title\n--- \nx\nT2\n--\ny"],
        "##\ntext\n## \nmore": ["##\ntext\n## \nmore"],
        "a" * 119 + "\n## A": ["a" * 119 + "\n\n## A"],
        "a" * 120 + "\n## A": ["a" * 120, "## A"],
    }
    assert dict(zip(cases, each(headings.split_h2_h4, *cases))) == cases


def test_split_generic(each):
    cases = {
        "# Top\nx\n###### A\ny": ["# Top\nx", "###### A\ny"],
        "1. One\n\n***\na\n2. Two\nno rule\nat all\nhere\n***": ["1. One\n\n***\na\n2. Two\nno rule\nat all\nhere\n***"],
        "# T\n1. One\n\n***\na": ["# T", "1. One\n\n***\na"],
        "# T\n1. One\n\n\n\nx\ny\n***\na": ["# T", "1. One\n\n\n\nx\ny\n***\na"],
        "# T\n1. One\nx\n\n***\na": ["# T", "1. One\nx\n\n***\na"],
        "# T\n1. One\nx\ny\nz\n***": ["# T\n1. One\nx\ny\nz\n***"],
        "# T\nTitle\n-\nx": ["# T", "Title\n-\nx"],
        "a" * 160 + "\n## A": ["a" * 160 + "\n\n## A"],
        "a" * 161 + "\n## A": ["a" * 161, "## A"],
    }
    assert dict(zip(cases, each(headings.split_generic, *cases))) == cases
    plain = lambda t: headings.split_generic(
        t, min_level=1, numbered_requires_hr=False, merge_short_preamble=False
    )
    assert each(plain, "x\n# A\nB\n==\n1. C", "x") == [["x", "# A", "B\n==", "1. C"], ["x"]]


def test_cuts_lose_no_text(each):
    text = "p\n# a\n## b\nT\n---\n1. n\n***\n\n### c\n\n\nx\n#### d"
    for cut in (headings.split_h3, headings.split_h2_h4, headings.split_generic):
        assert "".join("".join(each(cut, text)[0]).split()) == "".join(text.split())


def chunks(t):
    return F.filter(F.split(t, r"\|"), lambda c: c != "")


def test_recombine(each):
    # 10 words are 13 tokens; 20 words 26.
    ten = "w " * 9 + "w"
    options = ChunkOptions(max_tokens=126, heading_reserve=100)
    join = lambda t: sections.recombine(chunks(t), options)
    cases = {
        "# A|# B": ["# A", "# B"],
        "x|# A|y|z|# B": ["x", "# A\n\ny\n\nz", "# B"],
        "|".join([ten] * 10): ["\n\n".join([ten] * 9), ten],
        "# A|" + "|".join([ten] * 10): ["# A\n\n" + "\n\n".join([ten] * 9), ten],
        "1. n|2. m": ["1. n\n\n2. m"],
        "T\n--|x": ["T\n--\n\nx"],
        "Title\n---|x|Title\n---": ["Title\n---\n\nx", "Title\n---"],
        "": [],
    }
    assert dict(zip(cases, each(join, *cases))) == cases


def test_merge_orphans(each):
    long = "# L " + "w " * 14 + "w"
    join = lambda t: sections.merge_orphans(chunks(t))
    cases = {
        "# A|# B|# C": ["# A\n\n# B", "# C"],
        "# A|# B|# C|# D": ["# A\n\n# B", "# C\n\n# D"],
        f"# A|{long}|# B|{long}": [f"# A\n\n{long}", f"# B\n\n{long}"],
        f"{long}|# A": [long, "# A"],
        "x|# A|y": ["x", "# A\n\ny"],
        "": [],
    }
    assert dict(zip(cases, each(join, *cases))) == cases


def test_blocks_and_sentences(each):
    assert each(sections.blocks_of, "a\nb\n\nc\n* d\n  * e\n## f\ng\n\n\nh") == [
        ["a\nb", "\nc", "* d\n  * e", "## f\ng", "\n\nh"]
    ]
    assert each(sections.sentences_of, "A. B?  C!\nD e.f g") == [["A.", "B?", "C!", "D e.f g"]]


def test_split_oversized(each):
    # 150 tokens less a reserve of 100 and 2 for the heading: 48 tokens, 37 words, per body.
    options = ChunkOptions(max_tokens=150)
    split = lambda t: sections.split_oversized(t, options)
    w = lambda n, end="": " ".join(["w"] * n) + end
    body = "\n\n".join([w(30), w(30), w(60)])
    assert each(split, "## Head\n" + w(100), "## Head\n\n" + body) == [
        ["## Head\n" + w(100)],
        [
            f"## Head\n\n{w(30)}\n\n**[Continued in Part 2]**".replace("## Head\n\n", "## Head\n\n\n"),
            f"## Head\n\n**[Part 2 of 3 - Continued]**\n\n\n{w(30)}",
            f"## Head\n\n**[Part 3 of 3 - Continued]**\n\n\n{w(60)}",
        ],
    ]
    sentences = " ".join([w(20, ".")] * 6)
    got = each(split, "Head\n====\n" + sentences)[0]
    assert [g.count("w.") for g in got] == [1, 1, 1, 1, 1, 1]
    assert got[1] == f"Head\n====\n\n**[Part 2 of 6 - Continued]**\n\n{w(20, '.')}"
    # Without a heading a fixed one is used; lines before a heading are kept.
    none = each(split, w(120))[0]
    assert none == [f"## Content Section\n\n{w(120)}"]
    lead = each(split, f"{w(30)}\n## Head\n{w(120)}")[0]
    assert lead[0] == f"## Head\n\n{w(30)}\n\n**[Continued in Part 2]**"
    only = "## " + w(200)
    assert each(split, only) == [[only]]


def test_parts_stay_under_the_limit(each):
    options = ChunkOptions(max_tokens=160)
    text = "## H\n\n" + "\n\n".join("w " * n + "e." for n in (5, 12, 30, 7, 28, 3, 25))
    parts = each(lambda t: sections.split_oversized(t, options), text)[0]
    assert all(int(len(p.split()) * 1.3) <= 160 for p in parts)
    assert sum(p.count("e.") for p in parts) == 7


def test_many_sections_in_one_document(each):
    text = "\n".join(f"## S{i}\n\nwords here" for i in range(5_000))
    found = each(lambda t: sections.chunks_under_limit(headings.split_generic(t)), text)[0]
    assert len(found) == 2_500 and found[-1].endswith("## S4999\n\nwords here")


def test_rows_are_packed_like_arrays(spark):
    """Texts as rows, one of them of 60,000 blocks, give the parts that the column function gives."""
    from corpusloom.operators.row_packing import split_oversized_rows

    options = ChunkOptions(max_tokens=150)
    texts = ["", "short", "# Only a heading " + "x " * 300, "## H\n" + "word. " * 900 + "\n\n* a\n* b\n\n" + "c d " * 200]
    texts += ["lead " * 90 + "\n# H\n" + "\n\n".join(f"block {k} of some words here" for k in range(60_000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "k bigint, t string").repartition(3)
    found = {(r.k, r.piece_no): r.text for r in split_oversized_rows(rows, "k", "t", options).collect()}
    want = rows.select("k", F.posexplode(sections.split_oversized(F.col("t"), options)).alias("no", "text")).collect()
    assert found == {(r.k, r.no + 1): r.text for r in want} and len(found) > 3000


def test_rows_are_packed_in_one_pass(spark):
    """Texts are cut into units once; a key met twice keeps the parts of both texts, packed together, for each of its headings."""
    from corpusloom.operators.row_packing import split_oversized_rows

    options = ChunkOptions(max_tokens=120)
    text = "# H\n" + "\n\n".join(f"block {k} of some words here" for k in range(100))
    rows = spark.createDataFrame([(1, text), (2, text), (2, text), (None, text), (None, "short")], "k bigint, t string")
    made = split_oversized_rows(rows, "k", "t", options)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "PythonUDTF" not in plan
    found = made.collect()
    own = [r.piece_no for r in found if r.k == 1]
    assert sorted(own) == list(range(1, len(own) + 1)) and len(own) > 20
    assert {r.text for r in found if r.k is None} == {"short"}
    both = sorted(r.piece_no for r in found if r.k == 2)
    assert both[::2] == both[1::2] == list(range(1, len(both) // 2 + 1))
