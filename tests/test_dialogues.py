"""Answers to records: text, escapes, parsing, validity, metadata, retries, quality."""

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom import QualityOptions, RecordOptions
from corpusloom.functions import dialogue_json as dj
from corpusloom.operators import dialogues, quality
from corpusloom.operators.prompts import prompt_text, prompts
from corpusloom.sources import sinks

GOOD = {"conversations": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a b"}]}
G = json.dumps(GOOD)


def test_response_text(each):
    cases = {
        " x ": "x",
        "```json\n[1]\n```": "[1]",
        "```\n[1]\n```  ": "[1]",
        "```json [1]": "[1]",
        "a ``` b": "a ``` b",
        "": "",
    }
    assert dict(zip(cases, each(dj.response_text, *cases))) == cases


def test_response_text_from_candidates(spark):
    schema = "text string, candidates array<struct<parts:array<struct<text:string>>>>"
    rows = [
        (None, [([("a",), (None,), ("b",)],), ([("c",)],)]),
        ("t", [([("a",)],)]),
        ("", None),
    ]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    got = df.select(dj.response_text(F.col("text"), F.col("candidates"))).collect()
    assert [r[0] for r in got] == ["abc", "t", ""]


def test_sanitize_escapes(each):
    cases = {
        r"a\*b": "a*b",
        r"\[ \n \" \/ \\\\ \t": r"[ \n \" \/ \\\ \t",
        r"\u12g é": r"u12g é",
        r"\\*": r"\*",
        "end\\": "end",
    }
    assert dict(zip(cases, each(dj.sanitize_escapes, *cases))) == cases


def test_dialogue_items(each):
    def valid(text):
        return [json.loads(i) for i in each(dj.dialogue_items, text)[0]]

    assert valid(f"[{G}, {G}]") == [GOOD, GOOD]
    assert valid(f'[{G}, 1, "x", null, [], {{}}]') == [GOOD]
    assert valid(f"{G}\nnoise\n  {G}  \n{{bad}}") == [GOOD, GOOD]
    assert valid(G) == [GOOD]
    assert valid(json.dumps(GOOD, indent=2)) == [GOOD]
    assert valid(G.replace("a b", r"a\*b"))[0]["conversations"][1]["content"] == "a*b"
    # A valid escaped backslash is left alone.
    assert valid(G.replace("a b", r"a\\*b"))[0]["conversations"][1]["content"] == r"a\*b"
    for broken in ("", "x", "[]", "{}", "1", '"s"', f"[{G}", f"{G}]", f"{G}}}", f"{G},{G}", f"[{G}] [{G}]"):
        assert valid(broken) == [], broken
    assert valid(f"[{G}]\n{G}") == [GOOD]


def test_dialogue_validity(each):
    turn = {"role": "user", "content": "x"}
    yes = [
        GOOD,
        {"conversations": [turn, {"role": None, "content": None}]},
        {"conversations": [turn, {"role": {"a": 1}, "content": [1], "more": 2}], "extra": 1},
    ]
    no = [
        {}, {"conversations": None}, {"conversations": []}, {"conversations": [turn]},
        {"conversations": {"a": turn, "b": turn}}, {"conversations": "[1,2]"},
        {"conversations": [turn, "x"]}, {"conversations": [turn, None]},
        {"conversations": [turn, {"role": "user"}]}, {"conversations": [turn, {"content": "x"}]},
        {"conversations": [turn, [turn]]},
    ]
    found = [len(items) == 1 for items in each(dj.dialogue_items, *[json.dumps(i) for i in yes + no])]
    assert found == [True] * len(yes) + [False] * len(no)


def test_texts_equal_those_of_python(spark, each):
    """Order of keys at every depth, repeated keys, NaN, numbers and escapes come out as Python writes them."""
    turns = '"conversations":[{"content":"q","role":"user","z":{"y":1,"x":[{"b":2,"a":3}]}},{"role":"assistant","content":"\\u00e9"}]'
    texts = [
        "{%s}" % turns,
        '{"z":{"b":{"d":1,"c":2},"a":[]},%s,"a":1}' % turns,
        '{"topic":1,"url":"old",%s,"topic":{"k":NaN,"j":-Infinity,"k":1.50}}' % turns,
        '{"conversations":1,"n":1e5,%s,"i":123456789012345678901234567890,"s":"\\ud83d\\ude42 / \\/ \\t"}' % turns,
    ]
    want = [json.dumps(json.loads(t), ensure_ascii=False) for t in texts]
    assert each(dj.dialogue_items, *texts) == [[w] for w in want]
    assert each(dj.dialogue_items, "[" + ",".join(texts) + "]") == [want]
    assert each(dj.dialogue_items, "\n".join(texts) + "\nnoise") == [want]
    assert each(dj.dialogue_items, None, "{" * 100_000, '[{"a":"\\ud800"}]') == [None, [], []]

    rows = spark.createDataFrame([(k, w) for k, w in enumerate(want)], "k int, item string")
    made = rows.select("k", dj.record_json(F.col("item"), F.lit("u"), F.lit("en"), F.lit("May"), F.lit(3)).alias("r"))
    metadata = {"url": "u", "lang": "en", "date": "May", "answer_tokens": 3}
    for r in made.collect():
        assert r.r == json.dumps(json.loads(want[r.k]) | metadata, ensure_ascii=False)
    lone = '{"conversations":[{"role":"\\ud800","content":1},{"role":2,"content":3}]}'
    assert json.loads(each(dj.dialogue_items, lone)[0][0])["conversations"][0]["role"] == "\ufffd"


def test_records_keep_other_keys(spark):
    item = {
        **GOOD, "topic": 7, "nested": {"b": [1, 2.5, True, None], "a": "é/\"\n"},
        "url": "old", "lang": "xx", "date": "old", "answer_tokens": "old",
    }
    rows = [("r1", 0, json.dumps(item)), ("r2", 0, json.dumps(item)), ("r3", 0, G)]
    found = spark.createDataFrame(rows, "request_id string, seq int, item string").withColumn(
        "conversations", dj.turns_of(F.col("item"))
    )
    sources = spark.createDataFrame(
        [("r1", "u1", "May"), ("r2", "u2", ""), ("r3", "u3", None)], "request_id string, url string, date string"
    )
    got = {r["request_id"]: json.loads(r["record"]) for r in dialogues.records(found, sources).collect()}
    assert got["r1"] == {**item, "url": "u1", "lang": "en", "date": "May", "answer_tokens": 2}
    # Without a date the model's own one stays.
    assert got["r2"] == {**item, "url": "u2", "lang": "en", "answer_tokens": 2}
    assert got["r3"] == {**GOOD, "url": "u3", "lang": "en", "answer_tokens": 2}


def test_invalid_responses_are_logged_whole_up_to_a_limit(spark):
    rows = [("r1", 1, "bad " * 1000), ("r2", 1, f"[{G}]"), ("r3", 1, "")]
    df = spark.createDataFrame(rows, "request_id string, attempt int, raw string")
    got = {r["request_id"]: r for r in dialogues.invalid_responses(df).collect()}
    assert set(got) == {"r1", "r3"}
    assert len(got["r1"]["response_head"]) == 2000 and got["r1"]["total_len"] == 3999
    entry = spark.createDataFrame([("h", 3000)], "head string, n int").select(
        sinks.quarantine_entry(F.lit("u"), F.lit("t"), F.lit("p"), F.col("head"), F.col("n"))
    ).collect()[0][0]
    assert "URL: u\nGuide Title: t\n" in entry and "[Truncated. Total length: 3000 chars]" in entry


def test_prompts(spark, each):
    assert each(lambda t: prompt_text(F.lit("A {context} B {context}"), F.lit("T"), t), "## H\nx") == [
        "A Guide Title: T\n\nSection Hierarchy:\n  ## H B Guide Title: T\n\nSection Hierarchy:\n  ## H\n## H\nx"
    ]
    assert each(lambda t: prompt_text(F.lit("{context}|"), F.lit(""), t), "x") == ["Section Hierarchy:\nGuide Section|\nx"]
    parts = spark.createDataFrame(
        [("u", "t", 1, 1, "x"), ("u", "t", 1, 2, "")], "url string, guide_title string, chunk_no int, part_no int, text string"
    )
    assert prompts(parts).count() == 1


def test_retries_ask_only_what_is_pending(spark, tmp_path):
    asked = spark.createDataFrame([(f"r{i}", str(i)) for i in range(10)], "request_id string, prompt string")

    def model(prompt: pd.Series) -> pd.Series:
        return prompt.map(lambda p: f"[{G}]" if int(p) % 2 else "no")

    sizes = []

    def save(responses, attempt):
        path = str(tmp_path / f"attempt={attempt}")
        responses.write.parquet(path)
        saved = spark.read.parquet(path)
        sizes.append(saved.count())
        return saved

    rounds = dialogues.generate_with_retries(asked, model, save, RecordOptions(retry_limit=3))
    assert sizes == [10, 5, 5]
    assert dialogues.first_success(rounds[0].unionByName(rounds[1])).count() == 5
    assert dialogues.generate_with_retries(asked, model, save, RecordOptions(retry_limit=0)) == []


def test_first_success_takes_the_earliest_valid_attempt(spark):
    rows = [("a", 1, "no"), ("a", 2, f"[{G}]"), ("a", 3, G), ("b", 1, "no"), ("c", 1, G), ("c", 2, f"[{G}]")]
    df = spark.createDataFrame(rows, "request_id string, attempt int, raw string")
    got = {r["request_id"]: r["attempt"] for r in dialogues.first_success(df).collect()}
    assert got == {"a": 2, "c": 1}


def test_quality(spark, each):
    turns = [("system", "s"), ("user", "one two"), ("assistant", "a b c"), ("assistant", "d"), ("user", "x"), ("user", "y z"), ("assistant", "e f g h")]
    item = json.dumps({"conversations": [{"role": r, "content": c} for r, c in turns]})
    rows = spark.createDataFrame([("r", 0, item)], "request_id string, seq int, item string").withColumn(
        "conversations", dj.turns_of(F.col("item"))
    )
    options = QualityOptions(
        min_pairs=3, max_pairs=4, min_instruction_words=2, max_instruction_words=2, min_output_words=3, max_output_words=3
    )
    found = quality.with_quality(quality.pairs(rows), options).orderBy("turn_no").collect()
    assert [(r["turn_no"], r["question"], r["answer"], r["passes"]) for r in found] == [
        (1, "one two", "a b c", True), (5, "y z", "e f g h", False),
    ]
    per = quality.pairs_per_request(rows, options).collect()[0]
    assert (per["pairs"], per["within"]) == (2, False)
    asked = spark.createDataFrame([("r",), ("none",)], "request_id string")
    short = {r["request_id"]: r["pairs"] for r in quality.short_chunks(asked, rows, options).collect()}
    assert short == {"r": 2, "none": 0}
    assert each(quality.is_meta_question, "What does the TEXT say?", "In which context?", "What is the source?") == [
        True, False, True,
    ]


def test_answers_are_parsed_once(spark):
    rows = spark.createDataFrame([("a", 1, f"[{G}]")], "request_id string, attempt int, raw string")
    plan = dialogues.dialogues(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_a_batch_goes_back_in_pieces():
    long = json.dumps({"conversations": [{"role": "user", "content": "q" * 1000}, {"role": "assistant", "content": "a"}]})
    texts = [f"[{long}]" if k % 3 else None for k in range(6000)]
    pieces = list(dj.dialogue_items.func(iter([pa.array(texts), pa.array(texts[:1]), pa.array([], pa.string())])))
    assert len(pieces) > 4 and max(p.nbytes for p in pieces) < 4 << 20
    assert [i for p in pieces for i in p.to_pylist()] == [t and [t[1:-1]] for t in [*texts, texts[0]]]
