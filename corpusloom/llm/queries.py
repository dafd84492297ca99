"""The registered training-data queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.html_extraction import with_main_text
from corpusloom.llm.merkle import checked_documents
from corpusloom.llm.mixing import mixed, sized
from corpusloom.llm.near_dedup import near_duplicates
from corpusloom.llm.oracles import LLM_ORACLES as LLM_ORACLES
from corpusloom.llm.ordinal import graded, train
from corpusloom.llm.packing import packed
from corpusloom.llm.pseudonyms import KINDS, with_pseudonyms
from corpusloom.llm.rules import COUNTS, judged
from corpusloom.llm.secrets import with_secrets
from corpusloom.llm.spans import listed
from corpusloom.llm.store import table
from corpusloom.llm.substring import remove_repeats
from corpusloom.llm.token_counts import token_counts
from corpusloom.llm.vector_codes import compressed
from corpusloom.llm.winnowing import contamination

Query = Callable[[SparkSession, str], DataFrame]


def _count_of(array: str, kind_of, kind: str):
    return F.size(F.filter(array, lambda entry: kind_of(entry) == kind)).cast("bigint").alias(f"n_{kind}")


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = remove_repeats(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    found = token_counts(table(spark, sf, "documents").select("doc_id", "text"))
    return found.selectExpr("doc_id", "_n_bytes n_bytes", "_n_tokens n_tokens", "_over_limit over_limit")


def op3_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))


def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packed(table(spark, sf, "documents"))


def op5_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = graded(docs, train(docs, table(spark, sf, "labels")))
    return found.selectExpr(
        "doc_id", "_expected_grade expected_grade", "_p_ge_1 p_ge_1", "_p_ge_2 p_ge_2", "_kept kept"
    )


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return contamination(docs, table(spark, sf, "benchmark")).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixed(sized(table(spark, sf, "documents"), "doc_id", "text", "source"))


def op8_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    found = with_pseudonyms(table(spark, sf, "documents").select("doc_id", "text"))
    counts = [_count_of("_found", lambda k: k, kind) for kind, _ in KINDS]
    return found.select("doc_id", *counts, "text")


def op9_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = with_secrets(table(spark, sf, "documents").select("doc_id", "text"))
    counts = [_count_of("_base", lambda s: s["kind"], kind) for kind in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("_base")), 256).alias("base_sha256"), listed(F.col("_spans")).alias("spans")
    )


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = judged(docs, table(spark, sf, "labels"))
    return found.select("doc_id", *[F.col(f"_{n}").alias(n) for n in (*COUNTS, "base_failed", "kept", "score")])


def op11_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return with_main_text(pages).select("page_id", "url", "text", "n_chars", "n_lines", "n_deleted")


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    return compressed(vectors).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    found = checked_documents(table(spark, sf, "documents"))
    return found.selectExpr("key doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


LLM_QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_near_dedup": op3_near_dedup,
    "op4_packing": op4_packing,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontamination": op6_decontamination,
    "op7_mixing": op7_mixing,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_rules": op10_quality_rules,
    "op11_html_extraction": op11_html_extraction,
    "op12_vector_codes": op12_vector_codes,
    "op13_merkle_manifest": op13_merkle_manifest,
}

