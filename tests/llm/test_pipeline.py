"""Stages and queries over the smallest given tables, held against brute force."""

import os
import random

import pytest

import corpus_pipeline
from corpusloom.llm.queries import LLM_ORACLES, LLM_QUERIES
from corpusloom.llm.rules import RuleOptions
from corpusloom.llm.store import table
from tests.llm import brute
from tests.llm.conftest import words
from tests.llm.test_rules import brute_judged

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def texts(spark):
    return [tuple(r) for r in table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]


def test_stages_against_brute_force(spark, texts):
    docs = table(spark, SF_DIR, "documents")
    labels = [tuple(r) for r in table(spark, SF_DIR, "labels").select("doc_id", "quality", "toxic").collect()]
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    left = dict(texts)

    def ran(name):
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, SF_DIR)
        assert out.columns == docs.columns
        return out

    docs = ran("quality_rules")
    left = {r[0]: left[r[0]] for r in brute_judged(list(left.items()), labels, RuleOptions()) if r[-1]}
    assert sorted(r.doc_id for r in docs.collect()) == sorted(left)
    docs = ran("near_dedup")
    left = {r[0]: left[r[0]] for r in brute.near_duplicates(list(left.items()), percent=80) if r[3]}
    assert sorted(r.doc_id for r in docs.collect()) == sorted(left)
    docs = ran("decontamination")
    left = {r[0]: left[r[0]] for r in brute.contamination(list(left.items()), items) if not r[5]}
    assert sorted(r.doc_id for r in docs.collect()) == sorted(left)
    docs = ran("mixing")
    taken = [r.doc_id for r in docs.collect()]
    assert set(taken) <= set(left) and max(map(taken.count, taken)) <= 2
    packed = corpus_pipeline.packing(spark, docs, SF_DIR).collect()
    starts = [d for r in packed for d, s in zip(r.doc_ids, r.doc_starts) if s == 0]
    assert sorted(starts) == sorted(taken)


def test_near_dedup_stage_links_from_0_8_on(docs):
    """Texts without their first 20 and 21 words: similarities of 80 / 100 and 79 / 100 in shingles."""
    base = words(104).split()
    ends = [" ".join(base[k:]) for k in (0, 20)] + [" ".join(f"q{w}" for w in base[k:]) for k in (0, 21)]
    rows = list(enumerate(ends, 1))
    assert {r[0] for r in brute.near_duplicates(rows, percent=80) if r[3]} == {1, 3, 4}
    df = docs(rows)
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](df.sparkSession, df, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


def test_near_dedup_stage_against_brute_force_at_0_8(spark, texts):
    """All given documents, as two of them go at 0.8 only."""
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, table(spark, SF_DIR, "documents"), SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute.near_duplicates(texts, percent=80) if r[3])


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_quality_rules_stage_counts_all_trusted_documents(spark, docs, tmp_path, kind):
    """Labels whose ids are of another type than those of the documents make documents trusted like any others."""
    rng = random.Random(5)
    common = words(40).split()
    rows = [(k, words(30, f"v{k}x") if k % 50 == 49 else " ".join(rng.choices(common, k=30))) for k in range(200)]
    labels = [(k, 1, 0) for k in range(200) if k % 50 < 40]
    typed = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr(f"cast(doc_id as {kind}) doc_id", "quality", "toxic")
    typed.write.parquet(str(tmp_path / "labels.parquet"))
    kept = dict(corpus_pipeline.STAGES)["quality_rules"](spark, docs(rows), str(tmp_path))
    want = sorted(r[0] for r in brute_judged(rows, labels, RuleOptions()) if r[-1])
    assert want and not {49, 99, 149, 199} & set(want)
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r.cu_seqlens[-1] == r.n_tokens for r in rows)


def test_queries_against_brute_force(spark, texts):
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    rows = lambda name: sorted(map(tuple, LLM_QUERIES[name](spark, SF_DIR).collect()))
    assert rows("op1_substring_dedup") == sorted(brute.remove_repeats(texts))
    assert rows("op3_near_dedup") == sorted(brute.near_duplicates(texts))
    assert rows("op6_decontamination") == sorted(brute.contamination(texts, items))


@pytest.mark.parametrize("key", sorted(set(LLM_QUERIES) - set(LLM_ORACLES)))
def test_queries_give_every_document(spark, texts, key):
    found = LLM_QUERIES[key](spark, SF_DIR)
    if key == "op11_html_extraction":  # every page, as it reads `pages`
        pages = table(spark, SF_DIR, "pages").select("page_id").collect()
        assert sorted(found.select("page_id").collect()) == sorted(pages)
        return
    if key == "op4_packing":
        ids = {d for r in found.select("doc_ids").collect() for d in r.doc_ids}
    else:
        ids = {r.doc_id for r in found.select("doc_id").collect()}
    assert ids == {i for i, _ in texts}
