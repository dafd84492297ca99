"""Responses to dialogue records: parse, enrich, retry, quarantine, count."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.dialogue_json import (
    answer_tokens,
    dialogue_items,
    record_json,
    response_text,
    turns_of,
)
from corpusloom.operators.prompts import unique_requests
from corpusloom.options import RecordOptions


def parsed_responses(responses: DataFrame) -> DataFrame:
    """responses(request_id, attempt, raw, ...): adds `answer` and `items`.

    Both come out of generators, so that the answer is not cut out again, nor parsed again in another worker, for each use.
    """
    answered = responses.select("*", F.explode(F.array(response_text(F.col("raw")))).alias("answer"))
    return answered.select("*", F.explode(F.array(dialogue_items(F.col("answer")))).alias("items"))


def dialogues(responses: DataFrame) -> DataFrame:
    """One row per valid dialogue: request_id, attempt, seq, item, conversations."""
    return (
        parsed_responses(responses)
        .drop("raw", "answer")
        .select("*", F.posexplode("items").alias("seq", "item"))
        .drop("items")
        .withColumn("conversations", turns_of(F.col("item")))
    )


def invalid_responses(responses: DataFrame, options: RecordOptions = RecordOptions()) -> DataFrame:
    """Responses without any valid dialogue, with the head of the answer and its length."""
    return (
        parsed_responses(responses)
        .where(F.size("items") == 0)
        .withColumn("response_head", F.substring("answer", 1, options.logged_chars))
        .withColumn("total_len", F.length("answer"))
        .drop("raw", "answer", "items")
    )


def first_success(responses: DataFrame) -> DataFrame:
    """Per request the earliest attempt that holds a valid dialogue.

    Answers without one go before the shuffle; a request has at most `retry_limit` attempts.
    """
    others = [c for c in responses.columns if c not in ("request_id", "attempt")]
    return (
        parsed_responses(responses)
        .where(F.size("items") > 0)
        .groupBy("request_id")
        .agg(F.min(F.struct("attempt", *others)).alias("first"))
        .select("request_id", "first.*")
    )


def pending_requests(prompts: DataFrame, responses: DataFrame) -> DataFrame:
    """Prompts that no attempt has answered with a valid dialogue."""
    done = parsed_responses(responses).where(F.size("items") > 0).select("request_id")
    return prompts.join(done, "request_id", "left_anti")


def records(
    dialogue_rows: DataFrame, sources: DataFrame, options: RecordOptions = RecordOptions()
) -> DataFrame:
    """Join dialogues with sources(request_id, url, date) and add the record's metadata.

    A request that is listed several times counts once.

    The turns are read from the object after the join, so the text is shuffled once.
    """
    keyed = unique_requests(sources.select("request_id", "url", "date"))
    return (
        dialogue_rows.drop("conversations")
        .join(keyed, "request_id")
        .withColumn("conversations", turns_of(F.col("item")))
        .withColumn("lang", F.lit(options.lang))
        .withColumn("answer_tokens", answer_tokens(F.col("conversations")))
        .withColumn(
            "record",
            record_json(F.col("item"), F.col("url"), F.col("lang"), F.col("date"), F.col("answer_tokens")),
        )
    )


def records_per_url(record_rows: DataFrame) -> DataFrame:
    """Records per URL, and the total under a NULL URL."""
    return record_rows.rollup("url").agg(F.count(F.lit(1)).alias("records"))


def generate(
    prompts: DataFrame,
    model: Callable[[pd.Series], pd.Series],
    attempt: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Call a user-supplied model on batches of prompts: responses(request_id, attempt, raw).

    The result of a model call need not repeat, so write it to a table before using it twice.
    """
    asked = prompts.select("request_id", "prompt")
    if partitions:
        asked = asked.repartition(partitions, "request_id")

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"request_id": batch["request_id"], "attempt": attempt, "raw": model(batch["prompt"])}
            )

    return asked.mapInPandas(answer, "request_id string, attempt int, raw string")


def generate_with_retries(
    prompts: DataFrame,
    model: Callable[[pd.Series], pd.Series],
    save: Callable[[DataFrame, int], DataFrame],
    options: RecordOptions = RecordOptions(),
    save_pending: Callable[[DataFrame, int], DataFrame] | None = None,
) -> list[DataFrame]:
    """Up to `retry_limit` rounds; each asks only what is still without a valid dialogue.

    `save(responses, attempt)` writes a round to a table and returns it as read back, which
    keeps one model call per prompt and round even when executors are lost. `save_pending(prompts, attempt)` does so with
    what a round leaves open, so that a later round does not parse the answers of all earlier ones again.
    """
    rounds: list[DataFrame] = []
    pending = prompts
    for attempt in range(1, options.retry_limit + 1):
        saved = save(generate(pending, model, attempt), attempt)
        rounds.append(saved)
        if attempt < options.retry_limit:
            pending = pending_requests(pending, saved)
            pending = save_pending(pending, attempt) if save_pending else pending
    return rounds
