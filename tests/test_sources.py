"""Links, state, stored responses, sinks, streaming resume."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.tokenizers import plugged_tokens
from corpusloom.operators import resume
from corpusloom.sources import fetched, links, sinks
from corpusloom.streaming import batches
from corpusloom.streaming import links as stream


def test_links_in_order_and_once(spark, tmp_path):
    (tmp_path / "a.md").write_text(
        "- [one](http://x/1)\n![img](http://x/img)\n[two\nlines](https://x/2 \"T\") http://plain\n"
        "[ftp](ftp://x) [again](http://x/1) [bad](http://x/ y) [](http://x/3)\n[![i](http://x/in)](http://x/out)"
    )
    files = links.read_markdown_files(spark, str(tmp_path / "*.md"))
    found = links.unique_links(links.links_of(files)).orderBy("file", "pos").collect()
    # A linked image gives the address of the image, as a bracket may hold a bracket.
    assert [r["url"] for r in found] == ["http://x/1", "https://x/2", "http://x/3", "http://x/in"]
    assert links.read_markdown_files(spark, str(tmp_path / "none.md")).count() == 0


def test_state_round_trip(spark, tmp_path):
    path = str(tmp_path / "state")
    assert links.read_processed_links(spark, path).count() == 0
    urls = spark.createDataFrame([("u1",), ("u2",), ("u1",)], "url string")
    links.append_processed_links(urls, path)
    links.append_processed_links(spark.createDataFrame([("u3",)], "url string"), path)
    processed = links.read_processed_links(spark, path)
    assert sorted(r["url"] for r in processed.collect()) == ["u1", "u2", "u3"]
    all_links = spark.createDataFrame([("u1", 0), ("u9", 1)], "url string, pos int")
    assert [r["url"] for r in resume.pending_links(all_links, processed).collect()] == ["u9"]
    assert [r["url"] for r in resume.done_links(all_links, processed).collect()] == ["u1"]
    assert tuple(resume.run_summary(all_links, processed).collect()[0]) == (2, 1, 1)
    counts = spark.createDataFrame([("u9", 0), (None, 5)], "url string, records long")
    assert resume.finished_urls(all_links, counts).count() == 0
    assert resume.finished_urls(all_links, counts, mark_empty=True).count() == 2


def test_unwrap_response(spark):
    rows = [
        ("text", "# body"),
        ("reader", json.dumps({"data": {"title": "T", "url": "own", "content": "c", "more": 1}})),
        ("reader", json.dumps({"content": "c"})),
        ("reader", "{}"),
        ("converter", json.dumps({"markdown": "m"})),
        ("converter", "{}"),
    ]
    df = spark.createDataFrame(rows, "kind string, raw string").coalesce(1)
    got = df.select(fetched.unwrap_response(F.col("kind"), F.col("raw"), F.lit("u")).alias("r")).collect()
    assert [tuple(r["r"]) for r in got] == [
        ("", "u", "# body"), ("T", "own", "c"), ("", "u", "c"), ("", "u", ""), ("", "u", "m"), ("", "u", ""),
    ]


def test_drop_empty_computes_the_text_once(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None)], "id int, content string")
    kept = fetched.drop_empty(df.withColumn("content", F.upper("content")))
    assert [tuple(r) for r in kept.collect()] == [(1, "A")]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1


def test_corpus_block_bytes(spark, tmp_path):
    df = spark.createDataFrame(
        [(" body\nmore ", "u", "May", "T"), ("b", "u", "", "")], "plain string, url string, date string, title string"
    ).coalesce(1)
    blocks = df.select(sinks.corpus_block(*[F.col(c) for c in df.columns]).alias("block"))
    sinks.write_corpus_blocks(blocks, str(tmp_path / "out"))
    files = [f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]
    text = "".join((tmp_path / "out" / f).read_text() for f in sorted(files))
    rule = "=" * 80
    assert text == (
        f"Guide Title: T\nSource URL: u\nGuide Date: May\n\nbody\nmore\n\n{rule}\n\n\n\n"
        f"Guide Title: Unknown\nSource URL: u\n\nb\n\n{rule}\n\n\n\n"
    )
    sinks.write_jsonl(blocks.select(F.lit('{"a":"é"}').alias("record")), str(tmp_path / "jsonl"))
    assert spark.read.text(str(tmp_path / "jsonl")).count() == 2


def test_stream_passes_each_url_once_over_runs(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "work")
    schema = "url string, n int"

    def add(*urls):
        spark.createDataFrame([(u, 1) for u in urls], schema).coalesce(1).write.mode("append").parquet(source)

    add("a", "b", "a")
    assert sorted(r["url"] for r in stream.incremental_urls(spark, source, schema, folder).collect()) == ["a", "b"]
    add("b", "c")
    got = stream.incremental_urls(spark, source, schema, folder)
    assert sorted(r["url"] for r in got.collect()) == ["a", "b", "c"]


def test_row_operators_run_on_a_stream(spark, tmp_path):
    from corpusloom.plans.documents import document_prompts

    source = str(tmp_path / "docs")
    schema = "doc_id long, url string, title string, content string"
    rows = [(1, "https://garmoth.com/x", "", "# T\n## A\nx\n## B\n" + "\n".join(f"* i{k}" for k in range(30)))]
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(source)
    streamed = document_prompts(spark.readStream.schema(schema).parquet(source)).select("request_id", "prompt")
    stream.run_available(streamed, str(tmp_path / "sink"), str(tmp_path / "checkpoint"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "sink")).collect()}
    want = {tuple(r) for r in document_prompts(docs).select("request_id", "prompt").collect()}
    assert got == want and len(got) == 4


def test_work_folder_is_under_the_configured_one(tmp_path):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": str(tmp_path)}.get(key, default)

    class Session:
        conf = Conf()

    first, second = stream.work_folder(Session, "x"), stream.work_folder(Session, "x")
    assert first.startswith(str(tmp_path)) and first != second


@pytest.mark.parametrize("text,want", [("a b", 3), ("", 0), (None, 0)])
def test_plugged_tokenizer(each, text, want):
    assert each(plugged_tokens(lambda: len), text) == [want]


def test_template(spark, tmp_path):
    from corpusloom.sources.templates import read_template

    (tmp_path / "t.txt").write_text("Own {context}\n\nend")
    assert read_template(spark, str(tmp_path / "t.txt")) == "Own {context}\n\nend"
    assert "{context}" in read_template(spark, str(tmp_path / "none.txt"))
    assert "{context}" in read_template(spark, None)


def test_files_read_by_name_hold_rows_in_order(spark, tmp_path):
    """A URL with a third of all rows is several ranges, none of which holds more than its share."""
    rows = spark.range(30_000).selectExpr(
        "IF(id % 3 = 0, 'https://hot.org/', concat('https://x.org/', id % 997)) AS url",
        "id DIV 7 AS chunk_no",
        "CAST(id % 7 AS int) AS seq",
    )
    keys = ["url", "chunk_no", "seq"]
    text = F.concat_ws(" ", *keys)
    path = str(tmp_path / "series")
    shuffled = rows.orderBy(F.xxhash64(*keys)).withColumn("record", text)
    with_aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_jsonl(shuffled, path, order=keys)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_aqe)
    files = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    written = [open(f"{path}/{name}").read().splitlines() for name in files]
    assert len(files) == 8 and max(map(len, written)) < 2 * 30_000 / 8
    got = [line for lines in written for line in lines]
    want = sorted((r.url, r.chunk_no, r.seq) for r in rows.collect())
    assert got == [f"{u} {c} {s}" for u, c, s in want]
    # Lines are numbered over all files, also where files are read in many splits.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = {r.line_no: r.value for r in sinks.numbered_lines(spark, path).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [found[k + 1] for k in range(len(got))] == got


def test_ordered_plan_has_a_range_partitioning_and_no_total_sort(spark):
    plan = sinks.in_order(spark.range(10).selectExpr("id", "id % 3 AS pos"), ["pos", "id"])._jdf.queryExecution().toString()
    assert "rangepartitioning(pos" in plan and re.search(r"Sort \[pos#.*\], false", plan)
    assert not re.search(r"Sort \[pos#.*\], true", plan)


def test_order_of_null_keys_and_empty_rows(spark, tmp_path):
    rows = spark.createDataFrame([(2, "b"), (None, "a"), (1, "c")], "k int, record string")
    sinks.write_jsonl(rows, str(tmp_path / "s"), order=["k"])
    found = sinks.numbered_lines(spark, str(tmp_path / "s")).orderBy("line_no").collect()
    assert [tuple(r) for r in found] == [(1, "a"), (2, "c"), (3, "b")]
    sinks.write_jsonl(rows.where("k > 5"), str(tmp_path / "none"), order=["k"])
    assert sinks.numbered_lines(spark, str(tmp_path / "none")).count() == 0


def test_urls_are_forgotten_after_the_horizon(spark, tmp_path):
    """Repeats within the horizon go, late rows go, the state shrinks, and a URL that was forgotten passes again."""
    source, folder = str(tmp_path / "source"), str(tmp_path / "work")
    schema = "url string, ingest_time timestamp"

    def run(rows):
        df = spark.createDataFrame(rows, "url string, t string").selectExpr("url", "CAST(t AS timestamp) AS ingest_time")
        df.write.mode("append").parquet(source)
        query = stream.recent_urls(spark, source, schema, folder, "12 hours")
        states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
        return states[-1]["numRowsTotal"], sum(s["numRowsDroppedByWatermark"] for s in states)

    def passed():
        return sorted((r.url, str(r.t)) for r in spark.read.parquet(f"{folder}/recent").selectExpr("url", "ingest_time AS t").collect())

    first = [(f"u{k}", "2024-01-01 00:00:00") for k in range(40)]
    assert run(first + first) == (40, 0)
    assert run([("u1", "2024-01-01 02:00:00"), ("u2", "2024-01-01 03:00:00")]) == (40, 0)
    assert len(passed()) == 40
    # Three days later one URL is held and forty are forgotten.
    assert run([("x", "2024-01-04 00:00:00")])[0] == 1
    held, late = run([("u1", "2024-01-04 01:00:00"), ("u1", "2024-01-04 02:00:00"), ("y", "2024-01-02 00:00:00")])
    assert (held, late) == (2, 1)
    again = [p for p in passed() if p[0] in ("u1", "x", "y")]
    assert [p[0] for p in again] == ["u1", "u1", "x"] and again[0][1] == "2024-01-01 00:00:00"
    # Nothing new: nothing passes.
    before = passed()
    stream.recent_urls(spark, source, schema, folder, "12 hours")
    assert passed() == before


def test_a_batch_that_dies_is_run_again_and_counted_once(spark, tmp_path):
    """Three batches, the second of which dies after its table was written: the tables equal those of one batch plan."""
    pages = spark.createDataFrame(
        [(k, f"https://x.org/{k}", f"<h1>Page {k}</h1><p>words {k} &amp; more</p>") for k in range(30)],
        "page_id bigint, url string, html string",
    )
    source, out, checkpoint = (str(tmp_path / n) for n in ("source", "out", "checkpoint"))
    tables = batches.page_prompts_of()
    died = []

    def dies_once(rows):
        if not died:
            died.append(True)
            batches.write_batch(tables(rows.limit(3)), out, 1)
            os.remove(next((tmp_path / "out" / "_done" / "1").glob("_SUCCESS")))
            for marker in (tmp_path / "out" / "_done" / "1").glob("*"):
                os.remove(marker)
            raise RuntimeError("killed")
        return tables(rows)

    def run(k, tables_of):
        pages.where(F.col("page_id") % 3 == k).write.mode("append").parquet(source)
        batches.run_batches(spark.readStream.schema(pages.schema).parquet(source), tables_of, out, checkpoint)

    def read():
        return batches.read_batches(spark, out, "prompts", batches.PROMPTS)

    assert read().count() == 0
    run(0, tables)
    with pytest.raises(Exception, match="killed"):
        run(1, dies_once)
    # What the dead batch wrote is not seen.
    assert {r.batch for r in read().collect()} == {0}
    batches.run_batches(spark.readStream.schema(pages.schema).parquet(source), tables, out, checkpoint)
    run(2, tables)
    want = sorted(r.request_id for r in tables(pages)["prompts"].collect())
    assert len(want) == 30 and sorted(r.request_id for r in read().collect()) == want
    assert {r.batch for r in read().collect()} == {0, 1, 2}
