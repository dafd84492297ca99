"""Whole runs over files: resume, quarantine, rerun of a failed run, no spreading of large tables."""

import json

import pandas as pd

from corpusloom import RecordOptions
from corpusloom.plans import inputs
from corpusloom.plans.run import RunOptions, run_corpus, run_records
from corpusloom.sources import links

GOOD = json.dumps([{"conversations": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a b"}]}])


def pages(spark, n):
    rows = [(i, f"https://x.org/{i}", f"<h1>Page {i}</h1><p>words {i}</p>") for i in range(n)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def link_files(spark, n):
    text = "\n".join(f"[p](https://x.org/{i})" for i in range(n))
    return spark.createDataFrame([("links.md", text)], "file string, text string")


def model(prompt: pd.Series) -> pd.Series:
    return prompt.map(lambda p: "no json" if "words 3" in p else GOOD)


def test_records_run_and_resume(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    options = RunOptions(records=RecordOptions(retry_limit=2))

    def run(n, run_id):
        got = run_records(spark, link_files(spark, n), pages(spark, 6), model, out, run_id, state, options)
        return {r["url"]: r["records"] for r in got.collect()}

    first = run(4, "a")
    assert first[None] == 3 and "https://x.org/3" not in first
    assert spark.read.parquet(f"{out}/responses/run=a").count() == 5
    quarantined = spark.read.text(f"{out}/quarantine/run=a", wholetext=True).collect()
    assert sum(r[0].count("INVALID MODEL RESPONSE") for r in quarantined) == 2

    # Repeating a finished run gives its tables again.
    assert run(4, "a") == first
    # A later run asks the page without a record again, and the new ones.
    later = run(6, "b")
    assert later == {None: 2, "https://x.org/4": 1, "https://x.org/5": 1}
    assert links.read_processed_links(spark, state).count() == 5
    record = json.loads(spark.read.text(f"{out}/records/run=b").collect()[0][0])
    assert record["lang"] == "en" and record["answer_tokens"] == 2 and "date" not in record


def test_a_run_repeated_before_its_state_was_written_gives_the_same(spark, tmp_path):
    out = str(tmp_path / "out")
    for attempt in range(2):
        run_records(spark, link_files(spark, 3), pages(spark, 3), model, out, "a", str(tmp_path / f"s{attempt}"))
    assert spark.read.text(f"{out}/records/run=a").count() == 3


def test_corpus_run(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert run_corpus(spark, link_files(spark, 3), pages(spark, 6), out, "a", state).count() == 3
    assert run_corpus(spark, link_files(spark, 5), pages(spark, 6), out, "b", state).count() == 2
    text = "".join(r[0] for r in spark.read.text(f"{out}/corpus/run=b", wholetext=True).collect())
    assert text.count("=" * 80) == 2 and text.endswith("=" * 80 + "\n\n\n\n")


def test_tables_are_dealt_only_on_request(spark, tmp_path):
    pages(spark, 5).write.parquet(str(tmp_path / "pages.parquet"))

    def shuffles():
        table = inputs.table(spark, str(tmp_path), "pages", "page_id")
        return "Exchange" in table._jdf.queryExecution().executedPlan().toString()

    assert not shuffles()
    spark.conf.set(inputs.SPREAD, "4")
    assert shuffles()
    spark.conf.unset(inputs.SPREAD)


def test_document_plan_has_no_shuffle(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from corpusloom.plans.documents import document_prompts

    docs = spark.range(10).select(
        F.col("id").alias("doc_id"), F.lit("https://garmoth.com/x").alias("url"), F.lit("").alias("title"), F.lit("# a\nb").alias("content")
    )
    plan = document_prompts(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_a_long_conversation_keeps_all_pairs(spark):
    """A system turn and 65 pairs."""
    from corpusloom.operators.quality import pairs_of_turns

    rows = [(7, 0, "system", "s")] + [
        (7, 1 + k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(130)
    ]
    found = pairs_of_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()
    assert sorted((r.question, r.answer) for r in found) == sorted((f"t{k}", f"t{k + 1}") for k in range(0, 130, 2))


def test_several_captures_are_one_record(spark, tmp_path):
    captures = pages(spark, 3)
    for extra in (100, 200):
        captures = captures.unionByName(pages(spark, 3).selectExpr(f"page_id + {extra} AS page_id", "url", "html"))
    out = str(tmp_path / "out")
    run_records(spark, link_files(spark, 3), captures, model, out, "a", str(tmp_path / "state"))
    assert spark.read.parquet(f"{out}/responses/run=a").count() == 3
    assert spark.read.text(f"{out}/records/run=a").count() == 3
