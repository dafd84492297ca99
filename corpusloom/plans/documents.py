"""Whole plans over documents: cleaned text, plain-text corpus, chunks, parts, prompts.

Every step maps a row to rows of its own, so a plan is one stage without a shuffle.
Generators carry computed texts on; what follows reads the result instead of computing it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.markdown import guide_title, plain_text
from corpusloom.functions.text import let
from corpusloom.operators.cleaning import clean_by_url, extract_date
from corpusloom.operators.exact_chunks import Load, exact_chunks, numbered_chunks
from corpusloom.operators.headings import split_generic, split_h2_h4, split_h3
from corpusloom.operators.prompts import prompts
from corpusloom.operators.routing import route
from corpusloom.operators.sections import chunks_under_limit
from corpusloom.operators.structures import explode_parts, split_structures
from corpusloom.options import ChunkOptions, StructureOptions
from corpusloom.sources.fetched import drop_empty
from corpusloom.sources.sinks import corpus_block

SPLITTERS = {fv.SITE_WIKI: split_h3, fv.SITE_BLOG: split_h2_h4, fv.SITE_TOOL: split_generic}


def cleaned_documents(docs: DataFrame) -> DataFrame:
    """docs(doc_id, url, title, content) to (doc_id, url, date, guide_title, content).

    The date is read from the raw text. Rows without text, before or after cleaning, go.
    """
    content, url = F.col("content"), F.col("url")
    cleaned = drop_empty(docs).select(
        "doc_id",
        "url",
        "title",
        extract_date(content, url).alias("date"),
        clean_by_url(content, url).alias("content"),
    )
    return drop_empty(cleaned).select(
        "doc_id",
        "url",
        "date",
        guide_title(F.coalesce(F.col("title"), F.lit("")), F.col("content")).alias("guide_title"),
        "content",
    )


def corpus_blocks(cleaned: DataFrame) -> DataFrame:
    """Cleaned documents to plain-text blocks; empty ones go."""
    plain = drop_empty(cleaned.withColumn("content", plain_text(F.col("content"))))
    return plain.select(
        "doc_id",
        "url",
        "date",
        "guide_title",
        corpus_block(F.col("content"), F.col("url"), F.col("date"), F.col("guide_title")).alias("block"),
    )


def chunks_of(content: Column, url: Column, options: ChunkOptions = ChunkOptions(), splitters=SPLITTERS) -> Column:
    """Chunks of one document by site form; a page of no known site is one chunk."""

    def cut(b: Column) -> Column:
        sections = None
        for site, splitter in splitters.items():
            sections = (F if sections is None else sections).when(
                b["site"] == site, splitter(b["content"])
            )
        return F.when(b["site"] == "default", F.array(b["content"])).otherwise(
            chunks_under_limit(sections, options)
        )

    site = route(url, fv.STAGE_ORDER["chunk"])
    return let(F.struct(content.alias("content"), site.alias("site")), cut)


def chunked(cleaned: DataFrame, options: ChunkOptions = ChunkOptions()) -> DataFrame:
    """One row per chunk: adds chunk_no (from 1) and text."""
    return cleaned.select(
        "doc_id",
        "url",
        "date",
        "guide_title",
        F.posexplode(chunks_of(F.col("content"), F.col("url"), options)).alias("_no", "text"),
    ).select("doc_id", "url", "date", "guide_title", (F.col("_no") + 1).alias("chunk_no"), "text")


def chunked_exact(
    cleaned: DataFrame, load: Load, options: ChunkOptions = ChunkOptions(), splitters=SPLITTERS
) -> DataFrame:
    """Like `chunked`, with chunks under the limit by the count of a real tokenizer. A page of no known site is one chunk here too.

    Both kinds of pages are told apart by URL alone, before they are cleaned, so no page is cleaned twice.
    """
    site, own = route(F.col("url"), fv.STAGE_ORDER["chunk"]), ("doc_id", "url", "date", "guide_title")
    sections = None
    for name, splitter in splitters.items():
        sections = (F if sections is None else sections).when(site == name, splitter(F.col("content")))
    cut = cleaned.where(site.isin(*splitters)).select(*own, sections.alias("sections"))
    whole = cleaned.where(~site.isin(*splitters)).select(*own, F.lit(1).alias("chunk_no"), F.col("content").alias("text"))
    return numbered_chunks(exact_chunks(cut, "sections", load, options)).unionByName(whole)


def parts_of(chunk_rows: DataFrame, options: StructureOptions = StructureOptions()) -> DataFrame:
    """One row per part of a chunk; most chunks are one part."""
    return explode_parts(
        chunk_rows.withColumnRenamed("text", "chunk"), split_structures(F.col("chunk"), options)
    ).drop("chunk")


def document_prompts(
    docs: DataFrame,
    chunk_options: ChunkOptions = ChunkOptions(),
    structure_options: StructureOptions = StructureOptions(),
    template: str = fv.DEFAULT_TEMPLATE,
    tokenizer: Load | None = None,
) -> DataFrame:
    """Documents to prompts, ready for a model. With a tokenizer the chunk limit is one of its tokens, else of estimated ones."""
    cleaned = cleaned_documents(docs)
    chunks = chunked_exact(cleaned, tokenizer, chunk_options) if tokenizer else chunked(cleaned, chunk_options)
    return prompts(parts_of(chunks, structure_options), template)
