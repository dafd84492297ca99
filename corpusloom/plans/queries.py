"""The registered queries: every operator over whole tables, one DataFrame each."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.dialogue_json import response_text, sanitize_escapes
from corpusloom.functions.html import html_to_markdown as html_markdown
from corpusloom.functions.markdown import guide_title, heading_context, plain_text
from corpusloom.functions.text import tokens, words
from corpusloom.functions.tokenizers import plugged_tokens
from corpusloom.operators import cleaning, dialogues, headings, quality, resume, routing, sections, structures
from corpusloom.operators.exact_chunks import BETWEEN_WORDS, ExactTokenizer, recombine_exact
from corpusloom.operators.prompts import prompts, unique_requests
from corpusloom.operators.row_packing import split_oversized_rows
from corpusloom.options import ChunkOptions, QualityOptions
from corpusloom.plans import documents, inputs
from corpusloom.sources import fetched, links, sinks
from corpusloom.streaming import batches
from corpusloom.streaming.links import incremental_urls, recent_urls, work_folder

Query = Callable[[SparkSession, str], DataFrame]

SMALL_CHUNKS = ChunkOptions(max_tokens=250)
SMALL_QUALITY = QualityOptions(
    min_pairs=2, max_pairs=4, min_instruction_words=6, max_instruction_words=48,
    min_output_words=14, max_output_words=200,
)

# An example rule table for the hosts in `pages`.
RULES = (
    ("clean", 1, "example.org", "keep"), ("clean", 2, "example.com", "strict"),
    ("clean", 3, "blog.", "blog"),
    ("fetch", 1, "blog.", "reader"), ("fetch", 2, "example.com", "converter"),
    ("fetch", 3, "example.net", "text"),
)


def _wide(df: DataFrame) -> DataFrame:
    """Integers as BIGINT."""
    return df.select(
        *[F.col(n).cast("bigint").alias(n) if t in ("int", "tinyint") else F.col(n) for n, t in df.dtypes]
    )


def _over(rows, column: Callable[[Column], Column], name: str, key: str = "doc_id") -> Query:
    """A column function over the content of input rows."""
    return lambda spark, sf: _wide(rows(spark, sf).select(key, column(F.col("content")).alias(name)))


def _pieces(rows, column: Callable[[Column], Column], name: str = "text") -> Query:
    """A column function that gives an array, one row per entry."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        found = rows(spark, sf).select("doc_id", F.posexplode(column(F.col("content"))).alias("_no", name))
        return found.select("doc_id", (F.col("_no") + 1).cast("bigint").alias("piece_no"), name)

    return query


def oversize_by_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(split_oversized_rows(inputs.guides(spark, sf), "doc_id", "content", SMALL_CHUNKS))


def _parts(rows, column: Callable[[Column], Column]) -> Query:
    return lambda spark, sf: _wide(
        structures.explode_parts(rows(spark, sf), column(F.col("content"))).drop("content")
    )


def _untitled(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.site_pages(spark, sf).withColumn("title", F.lit(""))


def _documents_text(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "documents", "doc_id").select("doc_id", F.col("text").alias("content"))


def html_to_markdown(spark: SparkSession, sf: str) -> DataFrame:
    return fetched.documents_from_html(inputs.table(spark, sf, "pages", "page_id"))


def html_forms(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.html_forms(spark, sf).select("doc_id", html_markdown(F.col("html")).alias("content"))


def html_depths(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.html_depths(spark, sf).select("doc_id", html_markdown(F.col("html")).alias("content"))


def unwrap_response(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.fetched(spark, sf).select(
        "page_id",
        F.inline(F.array(fetched.unwrap_response(F.col("kind"), F.col("raw"), F.col("url")))),
    )


def docs_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    docs = inputs.table(spark, sf, "documents", "doc_id").selectExpr(
        "doc_id", "CASE doc_id % 9 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE text END AS content"
    )
    return fetched.drop_empty(docs)


def guide_titles(spark: SparkSession, sf: str) -> DataFrame:
    title = F.expr("CASE WHEN doc_id % 4 = 0 THEN concat(' Fetched ', doc_id) ELSE '' END")
    return inputs.guides(spark, sf).select("doc_id", guide_title(title, F.col("content")).alias("guide_title"))


def plain_texts(spark: SparkSession, sf: str, safe: bool = False) -> DataFrame:
    forms = inputs.guides(spark, sf).select(F.lit("guide").alias("form"), "doc_id", "content").unionByName(
        inputs.structures_md(spark, sf).select(F.lit("structure").alias("form"), "doc_id", "content")
    )
    return forms.select("form", "doc_id", plain_text(F.col("content"), safe).alias("plain"))


def cpt_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return documents.corpus_blocks(documents.cleaned_documents(_untitled(spark, sf)))


def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return _wide(
        inputs.table(spark, sf, "documents", "doc_id").select(
            "doc_id", words(text).alias("words"), tokens(text).alias("tokens")
        )
    )


def token_counts_plugged(spark: SparkSession, sf: str) -> DataFrame:
    count = plugged_tokens(lambda: (lambda text: len(text.encode("utf-8")) // 4))
    return inputs.table(spark, sf, "documents", "doc_id").select("doc_id", count(F.col("text")).alias("tokens"))


def _pretokens() -> ExactTokenizer:
    """A tokenizer that SQL can tell too: words with their blank and runs of white space, four characters a token."""
    pieces = re.compile(r" ?[^ \n]+|[ \n]+")
    return ExactTokenizer(lambda text: sum((len(p) + 3) // 4 for p in pieces.findall(text)), BETWEEN_WORDS)


def exact_recombine(spark: SparkSession, sf: str) -> DataFrame:
    chunks = inputs.guides(spark, sf).select("doc_id", headings.split_generic(F.col("content")).alias("chunks"))
    sections_ = recombine_exact(chunks, "chunks", _pretokens, SMALL_CHUNKS)
    count = plugged_tokens(lambda: _pretokens().count)
    found = sections_.select("doc_id", F.posexplode("chunks").alias("_no", "text"))
    return found.select(
        "doc_id", (F.col("_no") + 1).cast("bigint").alias("piece_no"), "text", count(F.col("text")).alias("tokens")
    )


def route_domain(spark: SparkSession, sf: str) -> DataFrame:
    return routing.route_by_rules(inputs.table(spark, sf, "pages").select("page_id", "url"), RULES)


def route_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Two rules of every page, looked for in all pages."""
    pages = inputs.table(spark, sf, "pages").select("page_id", "url")
    return routing.route_by_rule_table(pages, inputs.rule_table(spark, sf))


def site_routes(spark: SparkSession, sf: str) -> DataFrame:
    """URLs that hold two domains: each stage goes by its own order."""
    other = F.expr("CASE doc_id % 3 WHEN 0 THEN 'garmoth.com' WHEN 1 THEN 'blackdesertfoundry.com' ELSE 'none' END")
    urls = inputs.site_pages(spark, sf).select("doc_id", F.concat("url", F.lit("?ref="), other).alias("url"))
    return routing.with_routes(urls)


def extract_date(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.site_pages(spark, sf).select(
        "doc_id", cleaning.extract_date(F.col("content"), F.col("url")).alias("date")
    )


def clean_registry(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.site_pages(spark, sf).select(
        "doc_id", cleaning.clean_by_url(F.col("content"), F.col("url")).alias("cleaned")
    )


def part_markers(spark: SparkSession, sf: str) -> DataFrame:
    parts = sections.part_markers(
        headings.split_h3(F.col("content")), F.concat(F.lit("## Guide "), F.col("doc_id"))
    )
    found = inputs.guides(spark, sf).select("doc_id", F.posexplode(parts).alias("_no", "text"))
    return found.select("doc_id", (F.col("_no") + 1).cast("bigint").alias("piece_no"), "text")


def _section_rows(spark: SparkSession, sf: str) -> DataFrame:
    return (
        inputs.guides(spark, sf)
        .select("doc_id", "url", F.posexplode(headings.split_h3(F.col("content"))).alias("_no", "content"))
        .select("doc_id", "url", (F.col("_no") + 1).alias("chunk_no"), "content")
    )


def main_heading(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(
        _section_rows(spark, sf).select(
            "doc_id", "chunk_no", sections.main_heading(F.col("content")).alias("heading")
        )
    )


def heading_contexts(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(
        _section_rows(spark, sf).select(
            "doc_id", "chunk_no", heading_context(F.col("content")).alias("context")
        )
    )


def prompt_rows(spark: SparkSession, sf: str) -> DataFrame:
    parts = _section_rows(spark, sf).select(
        "doc_id",
        "url",
        F.concat(F.lit("Guide "), F.col("doc_id")).alias("guide_title"),
        "chunk_no",
        F.lit(1).alias("part_no"),
        F.col("content").alias("text"),
    )
    return _wide(
        prompts(parts, "About:\n{context}\n\nAgain: {context}\nSource:").select(
            "request_id", "doc_id", "chunk_no", "prompt"
        )
    )


def site_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way from a stored page to prompts."""
    return _wide(
        documents.document_prompts(_untitled(spark, sf), SMALL_CHUNKS).select(
            "request_id", "doc_id", "date", "guide_title", "chunk_no", "part_no", "n_parts", "kind", "prompt"
        )
    )


def page_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way from a crawled page's HTML to prompts."""
    docs = fetched.documents_from_html(inputs.table(spark, sf, "pages", "page_id")).withColumnRenamed("page_id", "doc_id")
    return _wide(
        documents.document_prompts(docs, SMALL_CHUNKS).select(
            "request_id", "doc_id", "date", "guide_title", "chunk_no", "part_no", "n_parts", "kind", "prompt"
        )
    )


def one_capture(spark: SparkSession, sf: str) -> DataFrame:
    """Pages and a later capture of each: one per URL is left."""
    pages = inputs.table(spark, sf, "pages").select("page_id", "url")
    later = pages.withColumn("page_id", F.col("page_id") + 1_000_000)
    return fetched.one_capture(pages.unionByName(later)).select("url", "page_id")


def conversation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return quality.pairs_of_turns(inputs.conversations(spark, sf))


def links_unique(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(links.unique_links(links.links_of(inputs.link_files(spark, sf))))


def _processed(spark: SparkSession, sf: str) -> DataFrame:
    return links.processed_links(inputs.state_lines(spark, sf))


def links_pending(spark: SparkSession, sf: str) -> DataFrame:
    return resume.pending_links(links_unique(spark, sf), _processed(spark, sf))


def links_done(spark: SparkSession, sf: str) -> DataFrame:
    return resume.done_links(links_unique(spark, sf), _processed(spark, sf))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return resume.run_summary(links_unique(spark, sf), _processed(spark, sf))


def incremental_links(spark: SparkSession, sf: str) -> DataFrame:
    schema = "page_id bigint, url string, html string"
    return incremental_urls(spark, f"{sf}/pages.{{parquet}}", schema, work_folder(spark, "links"))


def recent_links(spark: SparkSession, sf: str) -> DataFrame:
    """URLs with ingest times over four runs of a stream that forgets after twelve hours."""
    folder = work_folder(spark, "recent")
    for rows in inputs.ingested_pages(spark, sf):
        rows.write.mode("append").parquet(f"{folder}/source")
        recent_urls(spark, f"{folder}/source", "url string, ingest_time timestamp", folder, "12 hours")
    found = spark.read.schema("url string, ingest_time timestamp").parquet(f"{folder}/recent")
    return found.select("url", F.unix_seconds("ingest_time").alias("ingest_second"))


def streamed_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Pages to prompts in three runs of a stream, read back from the tables of its batches."""
    folder = work_folder(spark, "prompts")
    pages = inputs.table(spark, sf, "pages").select("page_id", "url", "html")
    for k in range(3):
        pages.where(F.pmod("page_id", F.lit(3)) == k).write.mode("append").parquet(f"{folder}/source")
        stream = spark.readStream.schema(pages.schema).parquet(f"{folder}/source")
        batches.run_batches(stream, batches.page_prompts_of(SMALL_CHUNKS), f"{folder}/out", f"{folder}/checkpoint")
    found = batches.read_batches(spark, f"{folder}/out", "prompts", batches.PROMPTS)
    return _wide(found.drop("url", "batch"))


def response_texts(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.responses(spark, sf).select("request_id", response_text(F.col("raw")).alias("answer"))


def sanitized(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.responses(spark, sf).select("request_id", sanitize_escapes(F.col("raw")).alias("repaired"))


def _dialogues(spark: SparkSession, sf: str) -> DataFrame:
    return dialogues.dialogues(inputs.responses(spark, sf))


def _joined(rows: DataFrame, *keep: str) -> DataFrame:
    conversation = F.col("conversations")
    return rows.select(
        *keep,
        F.size(conversation).cast("bigint").alias("n_turns"),
        F.array_join(conversation["role"], ",").alias("roles"),
        F.array_join(conversation["content"], "|").alias("contents"),
    )


def parse_dialogues(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(_joined(_dialogues(spark, sf), "request_id", "attempt", "seq"))


def dialogues_valid(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(
        dialogues.parsed_responses(inputs.responses(spark, sf)).select(
            "request_id", F.size("items").alias("valid_dialogues")
        )
    )


def invalid_responses(spark: SparkSession, sf: str) -> DataFrame:
    rows = dialogues.invalid_responses(inputs.responses(spark, sf))
    return _wide(
        rows.join(unique_requests(inputs.requests(spark, sf).select("request_id", "url", "prompt")), "request_id")
    )


def retry_rounds(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(dialogues.first_success(inputs.responses(spark, sf, attempts=2)))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return dialogues.records(_dialogues(spark, sf), inputs.requests(spark, sf))


def jsonl_records(spark: SparkSession, sf: str) -> DataFrame:
    record = F.col("record")
    turns = F.from_json(F.get_json_object(record, "$.conversations"), "array<struct<role:string,content:string>>")
    own = {k: F.get_json_object(record, f"$.{k}") for k in ("url", "lang", "date", "answer_tokens", "topic")}
    return _wide(
        _records(spark, sf).select(
            "request_id",
            "seq",
            *[v.alias(k) for k, v in own.items()],
            F.size(turns).alias("n_turns"),
            F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit(":"), t["content"])), "\x1f").alias("said"),
        )
    )


def records_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Whole records, byte for byte, of objects with nested, repeated and unordered keys."""
    found = dialogues.records(dialogues.dialogues(inputs.mixed_objects(spark, sf)), inputs.requests(spark, sf))
    return found.select("request_id", "record")


def ordered_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records as a file series in the order of URL, request and answer, read back by file name."""
    asked = unique_requests(inputs.requests(spark, sf).select("request_id", "url"))
    rows = _records(spark, sf).select("request_id", "seq", "record").join(asked, "request_id")
    folder = work_folder(spark, "records")
    sinks.write_jsonl(rows, folder, order=["url", "request_id", "seq"])
    own = [F.get_json_object("value", f"$.{k}").alias(k) for k in ("url", "topic", "answer_tokens")]
    return sinks.numbered_lines(spark, folder).select("line_no", *own)


def ordered_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of the plain-text corpus in the order of documents."""
    folder = work_folder(spark, "corpus")
    sinks.write_corpus_blocks(cpt_blocks(spark, sf).select("doc_id", "block"), folder, order=["doc_id"])
    return sinks.numbered_lines(spark, folder)


def records_per_url(spark: SparkSession, sf: str) -> DataFrame:
    return dialogues.records_per_url(_records(spark, sf).select("url"))


def processed_after_run(spark: SparkSession, sf: str) -> DataFrame:
    asked = inputs.requests(spark, sf).select("url")
    return resume.finished_urls(asked, records_per_url(spark, sf))


def answer_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(_records(spark, sf).select("request_id", "seq", "answer_tokens"))


def quality_gate(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(
        quality.with_quality(quality.pairs(_dialogues(spark, sf)), SMALL_QUALITY).select(
            "request_id", "seq", "turn_no", "question_words", "answer_words", "passes"
        )
    )


def pairs_per_chunk(spark: SparkSession, sf: str) -> DataFrame:
    return quality.pairs_per_request(_dialogues(spark, sf), SMALL_QUALITY)


def meta_question_filter(spark: SparkSession, sf: str) -> DataFrame:
    asked = quality.pairs(_dialogues(spark, sf)).withColumn(
        "question",
        F.when(F.col("turn_no") % 4 == 0, F.concat(F.lit("What does the Section say? "), F.col("question"))).otherwise(F.col("question")),
    )
    return _wide(
        asked.where(~quality.is_meta_question(F.col("question"))).select("request_id", "seq", "turn_no", "question")
    )


def short_chunks(spark: SparkSession, sf: str) -> DataFrame:
    asked = unique_requests(inputs.requests(spark, sf).select("request_id", "url"))
    return _wide(quality.short_chunks(asked, _dialogues(spark, sf), SMALL_QUALITY))


def generate_with_callable(spark: SparkSession, sf: str) -> DataFrame:
    def echo(prompt: pd.Series) -> pd.Series:
        return '[{"conversations":[{"role":"user","content":"' + prompt + '"},{"role":"assistant","content":"Yes."}]}]'

    return _wide(dialogues.generate(unique_requests(inputs.requests(spark, sf)), echo))


QUERIES: dict[str, Query] = {
    "html_to_markdown": html_to_markdown,
    "html_forms": html_forms,
    "html_depths": html_depths,
    "unwrap_response": unwrap_response,
    "docs_nonempty": docs_nonempty,
    "guide_title": guide_titles,
    "plain_text": plain_texts,
    "plain_text_safe": lambda spark, sf: plain_texts(spark, sf, safe=True),
    "cpt_blocks": cpt_blocks,
    "token_counts": token_counts,
    "token_counts_plugged": token_counts_plugged,
    "route_domain": route_domain,
    "route_rules": route_rules,
    "site_routes": site_routes,
    "extract_date": extract_date,
    "clean_default": _over(inputs.site_pages, cleaning.clean_default, "cleaned"),
    "clean_header_footer": _over(inputs.site_pages, cleaning.clean_header_footer, "cleaned"),
    "clean_intro_anchor": _over(inputs.site_pages, cleaning.clean_intro_anchor, "cleaned"),
    "clean_title_suffix": _over(inputs.site_pages, cleaning.clean_title_suffix, "cleaned"),
    "clean_registry": clean_registry,
    "heading_split_h3": _pieces(inputs.guides, headings.split_h3),
    "heading_split_h2_h4": _pieces(inputs.guides, headings.split_h2_h4),
    "heading_split_generic": _pieces(inputs.guides, headings.split_generic),
    "preamble_merge": _pieces(inputs.guides, lambda c: headings.merge_preamble(headings.split_h3(c), 160)),
    "main_heading": main_heading,
    "heading_context": heading_contexts,
    "sections_recombine": _pieces(
        inputs.guides, lambda c: sections.recombine(headings.split_generic(c), SMALL_CHUNKS)
    ),
    "orphan_merge": _pieces(inputs.guides, lambda c: sections.merge_orphans(headings.split_generic(c))),
    "blocks": _pieces(inputs.guides, sections.blocks_of),
    "sentences": _pieces(_documents_text, sections.sentences_of),
    "part_markers": part_markers,
    "exact_recombine": exact_recombine,
    "oversize_by_rows": oversize_by_rows,
    "oversize_split": _pieces(inputs.guides, lambda c: sections.split_oversized(c, SMALL_CHUNKS)),
    "detect_structures": lambda spark, sf: _wide(
        inputs.structures_md(spark, sf).select("doc_id", F.inline(F.array(structures.profile(F.col("content")))))
    ),
    "split_table": _parts(inputs.tables_md, structures.split_table),
    "split_list": _parts(inputs.lists_md, structures.split_list),
    "split_nested": _parts(inputs.nested_md, structures.split_nested),
    "structure_dispatch": _parts(inputs.structures_md, structures.split_structures),
    "prompts": prompt_rows,
    "site_prompts": site_prompts,
    "page_prompts": page_prompts,
    "one_capture": one_capture,
    "conversation_pairs": conversation_pairs,
    "links_unique": links_unique,
    "processed_links": _processed,
    "links_pending": links_pending,
    "links_done": links_done,
    "run_summary": run_summary,
    "incremental_links": incremental_links,
    "recent_links": recent_links,
    "streamed_prompts": streamed_prompts,
    "response_text": response_texts,
    "sanitize_escapes": sanitized,
    "parse_dialogues": parse_dialogues,
    "dialogues_valid": dialogues_valid,
    "invalid_responses": invalid_responses,
    "retry_rounds": retry_rounds,
    "jsonl_records": jsonl_records,
    "records_in_order": records_in_order,
    "ordered_records": ordered_records,
    "ordered_corpus": ordered_corpus,
    "records_per_url": records_per_url,
    "processed_after_run": processed_after_run,
    "answer_tokens": answer_tokens,
    "quality_gate": quality_gate,
    "pairs_per_chunk": pairs_per_chunk,
    "meta_question_filter": meta_question_filter,
    "short_chunks": short_chunks,
    "generate_with_callable": generate_with_callable,
}
