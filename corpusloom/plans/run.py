"""Whole runs: pending links to records, or to a plain-text corpus.

Every stage writes a table under `run=<run_id>` and reads it back. A repeated run with the
same id takes the same links, overwrites its own tables and nothing else, and the state is
added to last, so a run that fails can be started again without losing or doubling records.

Text files are written in the order of the links (file, place in it), then chunk, part and answer, as a run over one link
after the other would write them. The order is a range partitioning by all of these keys, so a page with very many records
is several ranges.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.operators import dialogues, resume
from corpusloom.operators.exact_chunks import Load
from corpusloom.options import ChunkOptions, RecordOptions, StructureOptions
from corpusloom.plans.documents import cleaned_documents, corpus_blocks, document_prompts
from corpusloom.sources import links, sinks
from corpusloom.operators.prompts import unique_requests
from corpusloom.sources.fetched import documents_from_html, one_capture


@dataclass(frozen=True)
class RunOptions:
    chunks: ChunkOptions = field(default_factory=ChunkOptions)
    structures: StructureOptions = field(default_factory=StructureOptions)
    records: RecordOptions = field(default_factory=RecordOptions)
    template: str = fv.DEFAULT_TEMPLATE
    mark_empty: bool = False
    tokenizer: Load | None = None


# Where a link stands; chunks and parts have their own numbers within its page, dialogues within their answer.
LINK_PLACE = ("file", "pos")
RECORD_ORDER = (*LINK_PLACE, "chunk_no", "part_no", "request_id", "seq")


def _saved(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pending_documents(
    spark: SparkSession, link_files: DataFrame, pages: DataFrame, state: str, saved_at: str
) -> tuple[DataFrame, DataFrame]:
    """Links that are not in the state, and their pages(page_id, url, html) as documents.

    The links of a run are fixed when it first starts, so that repeating a run, even one that
    has already finished, gives its tables again instead of emptying them.
    """
    if links.path_exists(spark, f"{saved_at}/_SUCCESS"):
        pending = spark.read.parquet(saved_at)
    else:
        found = links.unique_links(links.links_of(link_files))
        pending = _saved(
            resume.pending_links(found, links.read_processed_links(spark, state)), saved_at
        )
    keys = one_capture(pages.select("page_id", "url").join(pending.select("url"), "url", "left_semi"))
    wanted = pages.join(keys.select("page_id"), "page_id", "left_semi").dropDuplicates(["page_id"])
    return pending, documents_from_html(wanted).withColumnRenamed("page_id", "doc_id")


def run_corpus(
    spark: SparkSession, link_files: DataFrame, pages: DataFrame, out: str, run_id: str, state: str, mark_empty: bool = False
) -> DataFrame:
    """Pending pages to plain-text blocks; returns the finished URLs, with `mark_empty` also those without a block."""
    pending, docs = pending_documents(spark, link_files, pages, state, f"{out}/pending/run={run_id}")
    blocks = _saved(corpus_blocks(cleaned_documents(docs)).select("url", "block"), f"{out}/blocks/run={run_id}")
    placed = blocks.join(pending.select("url", *LINK_PLACE), "url")
    sinks.write_corpus_blocks(placed, f"{out}/corpus/run={run_id}", mode="overwrite", order=[*LINK_PLACE, "url"])
    finished = resume.finished_urls(pending, blocks.select("url", F.lit(1).alias("records")), mark_empty)
    finished = _saved(finished, f"{out}/finished/run={run_id}")
    links.append_processed_links(finished, state)
    return finished


def run_records(
    spark: SparkSession,
    link_files: DataFrame,
    pages: DataFrame,
    model: Callable[[pd.Series], pd.Series],
    out: str,
    run_id: str,
    state: str,
    options: RunOptions = RunOptions(),
) -> DataFrame:
    """Pending pages to prompts, answers and records; returns records per URL and in total."""

    def path(name: str) -> str:
        return f"{out}/{name}/run={run_id}"

    pending, docs = pending_documents(spark, link_files, pages, state, path("pending"))
    prompts = _saved(
        unique_requests(document_prompts(docs, options.chunks, options.structures, options.template, options.tokenizer)), path("prompts")
    )
    rounds = dialogues.generate_with_retries(
        prompts,
        model,
        lambda responses, attempt: _saved(responses, f"{path('responses')}/attempt={attempt}"),
        options.records,
        lambda pending, attempt: _saved(pending, f"{path('open_requests')}/attempt={attempt}"),
    )
    responses = spark.createDataFrame([], "request_id string, attempt int, raw string")
    for answered in rounds:
        responses = responses.unionByName(answered)

    found = dialogues.dialogues(responses)
    records = _saved(
        dialogues.records(found, prompts, options.records).select("request_id", "seq", "url", "record"),
        path("record_table"),
    )
    # Keys are put together before the records join, so that their texts move once more only.
    places = prompts.select("request_id", "url", "chunk_no", "part_no").join(pending.select("url", *LINK_PLACE), "url")
    ordered = records.drop("url").join(places, "request_id")
    sinks.write_jsonl(ordered, path("records"), mode="overwrite", order=RECORD_ORDER)

    invalid = dialogues.invalid_responses(responses, options.records).join(
        prompts.select("request_id", "guide_title", "prompt"), "request_id"
    )
    invalid = invalid.join(places, "request_id")
    entry = sinks.quarantine_entry(
        *[F.col(c) for c in ("url", "guide_title", "prompt", "response_head", "total_len")], options.records
    )
    logged = invalid.select(entry.alias("entry"), *LINK_PLACE, "chunk_no", "part_no", "request_id", "attempt")
    sinks.write_quarantine(
        logged, path("quarantine"), mode="overwrite", order=[*RECORD_ORDER[:-1], "attempt"]
    )

    per_url = _saved(dialogues.records_per_url(records), path("records_per_url"))
    finished = _saved(resume.finished_urls(pending, per_url, options.mark_empty), path("finished"))
    links.append_processed_links(finished, state)
    return per_url
