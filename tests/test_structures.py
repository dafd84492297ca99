"""Detecting and splitting tables, lists and nested bullets."""

from corpusloom import StructureOptions
from corpusloom.operators import structures

SMALL = StructureOptions(
    list_items_per_part=2, table_rows_per_part=2, nested_groups_per_part=2,
    min_list_items=3, min_table_rows=3, min_nested_groups=2, min_nested_items=4,
)


def kinds(each, *texts):
    return [p["kind"] for p in each(lambda t: structures.profile(t, SMALL), *texts)]


def parts(each, split, text, **options):
    return [(p["kind"], p["text"]) for p in each(lambda t: split(t, SMALL, **options), text)[0]]


def test_detection_thresholds(each):
    rows = "| h |\n|---|\n" + "| r |\n"
    assert kinds(
        each,
        "| h |\n|---|\n| 1 |\n| 2 |\n| 3 |",
        "| h |\n|---|\n| 1 |\n| 2 |",
        rows,
        "* a\n- b\n3. c",
        "* a\n- b\n3. -",
        "* a\n  * b\n* c\n- d\n- e",
        "* a\n  * b\n* c\n  * d",
        "* a\n  * 1\n  * 2\n  * 3\n  * 4",
        "  * x\n  * y\n  * z\n  * q\n* a\n  * b",
        "* É one\n* ü two\n* ß three",
        "* a\n\n\n\n  * b\n- c\n- d",
        "* a\n\n\n\n\n  * b\n- c\n- d",
        "* a\ntext\n  * b\n- c\n- d",
    ) == [
        "table", "plain", "plain", "list", "plain", "plain", "nested", "nested", "plain", "list",
        "plain", "list", "list",
    ]


def test_rows_with_a_blank_first_cell_count(each):
    profile = each(lambda t: structures.profile(t, SMALL), "| h |\n| :-: |\n|   | x |\n| 1 |")[0]
    assert profile["table_rows"] == 2


def test_part_markers_are_not_counted(each):
    marked = "* **[Part 1 of 3 - Continued]**a\n  * b\n**[Part 1 of 3]**\n* c\n  * d"
    assert each(lambda t: structures.profile(t, SMALL), marked)[0]["nested_groups"] == 2


def test_split_table(each):
    text = "# T\n**Name**\n| h | i |\n|---|---|\n| 1 | a |\n|  | b |\n| 3 | c |\n\nafter\n| x |"
    head = "# T\n**Name**\n\n\n**[Part {k}: Rows {a} of 3 total - Name]**\n\n\n| h | i |\n|---|---|\n"
    want = [
        ("rows", head.format(k=1, a="1-2") + "| 1 | a |\n|  | b |"),
        ("rows", head.format(k=2, a="3-3") + "| 3 | c |"),
    ]
    assert parts(each, structures.split_table, text, keep_rest=False) == want
    assert parts(each, structures.split_table, text) == want + [("rest", "after\n| x |")]
    assert parts(each, structures.split_table, "| h |") == [("plain", "| h |")]
    assert parts(each, structures.split_table, "no table") == [("plain", "no table")]
    # A blank line above means no name, other text above is the name.
    assert parts(each, structures.split_table, "x\n\n| h |\n| 1 |")[0][1] == (
        "x\n\n\n**[Part 1: Rows 1-1 of 1 total]**\n\n\n| h |\n| 1 |"
    )
    assert "total - some text]" in parts(each, structures.split_table, "some text\n| h |\n| 1 |")[0][1]


def test_split_list(each):
    text = "Intro\n\n* a\n  more\n* b\n\n1. c\nend"
    assert parts(each, structures.split_list, text) == [
        ("items", "Intro\n\n\n**[Part 1: Items 1-2 of 3 total]**\n\n\n* a\n  more\n* b\n"),
        ("items", "Intro\n\n\n**[Part 2: Items 3-3 of 3 total]**\n\n\n1. c\nend"),
    ]
    assert parts(each, structures.split_list, "* a")[0][1] == "\n**[Part 1: Items 1-1 of 1 total]**\n\n\n* a"


def test_split_nested(each):
    text = "# N\n* lone\ntext\n* a\n  * 1\n\n* b\n* c\n **[Part 1 of 2]**\n  * 2\n* [d](u)\ntail\n* e\n  * 3"
    got = parts(each, structures.split_nested, text)
    head = "# N\n* lone\ntext\n\n\n**[Part {k}: Groups {a} of 4 total]**\n\n\n"
    assert got == [
        ("groups", head.format(k=1, a="1-2") + "* a\n  * 1\n\n* b"),
        ("groups", head.format(k=2, a="3-4") + "* c\n  * 2\n* [d](u)"),
        ("rest", "tail\n* e\n  * 3"),
    ]
    assert parts(each, structures.split_nested, text, keep_rest=False) == got[:2]
    assert "total - N]" in parts(each, structures.split_nested, "# N\n* a\n  * 1")[0][1]
    assert parts(each, structures.split_nested, "* a\n* b") == [("plain", "* a\n* b")]


def test_dispatch_order_and_completeness(each):
    both = "* a\n  * 1\n* b\n  * 2\n\n| h |\n|---|\n| 1 |\n| 2 |\n| 3 |"
    got = parts(each, structures.split_structures, both)
    assert [k for k, _ in got] == ["groups", "rest"]
    rows = "| h |\n|---|\n" + "\n".join(f"| {i} |" for i in range(1001))
    got = parts(each, structures.split_structures, rows)
    assert len(got) == 501 and sum(t.count("\n| ") for _, t in got) == 1001 + 501


def test_explode_parts_numbers_parts(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "* a\n* b\n* c"), (2, "plain")], "doc_id int, content string")
    rows = structures.explode_parts(df, structures.split_structures(F.col("content"), SMALL)).collect()
    assert sorted((r["doc_id"], r["part_no"], r["n_parts"], r["kind"]) for r in rows) == [
        (1, 1, 2, "items"), (1, 2, 2, "items"), (2, 1, 1, "plain"),
    ]
