"""Quality gates for question/answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import let, words
from corpusloom.options import QualityOptions


def pairs_of(turns: Column) -> Column:
    """ARRAY<STRUCT<pair_no, question, answer>>: a user turn and the assistant turn after it."""

    def pair(bound: Column) -> Column:
        def one(turn: Column, i: Column) -> Column:
            after = F.get(bound, i + 1)
            return F.when(
                (turn["role"] == "user") & (after["role"] == "assistant"),
                F.struct(
                    i.alias("turn_no"),
                    turn["content"].alias("question"),
                    after["content"].alias("answer"),
                ),
            )

        return F.filter(F.transform(bound, one), lambda p: p.isNotNull())

    return let(turns, pair)


def pairs(dialogue_rows: DataFrame) -> DataFrame:
    """dialogues(request_id, seq, conversations, ...) to one row per pair."""
    return dialogue_rows.select(
        "request_id", "seq", F.inline(pairs_of(F.col("conversations")))
    )


def pairs_of_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """turns(conv_id, turn, role, text) to one row per user turn and the assistant turn right after it.

    A join on (conversation, turn), so a conversation of any length is spread like any other rows.
    """
    asked = turns.where(F.col("role") == "user").select(key, "turn", F.col("text").alias("question"))
    answers = turns.where(F.col("role") == "assistant").select(
        key, (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    return asked.join(answers, [key, "turn"]).select(key, "turn", "question", "answer")


def with_quality(pair_rows: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """Word counts of question and answer, and whether both are within bounds."""
    return pair_rows.withColumns(
        {"question_words": words(F.col("question")), "answer_words": words(F.col("answer"))}
    ).withColumn(
        "passes",
        F.col("question_words").between(options.min_instruction_words, options.max_instruction_words)
        & F.col("answer_words").between(options.min_output_words, options.max_output_words),
    )


def is_meta_question(question: Column) -> Column:
    """The question talks about the text it was made from."""
    return F.rlike(F.lower(question), F.lit(r"\b(?:" + "|".join(fv.META_QUESTION_WORDS) + r")\b"))


def pairs_per_request(dialogue_rows: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """Pairs per request and whether that number is within bounds."""
    return (
        dialogue_rows.withColumn("n", F.size(pairs_of(F.col("conversations"))))
        .groupBy("request_id")
        .agg(F.sum("n").alias("pairs"))
        .withColumn("within", F.col("pairs").between(options.min_pairs, options.max_pairs))
    )


def short_chunks(
    requests: DataFrame, dialogue_rows: DataFrame, options: QualityOptions = QualityOptions()
) -> DataFrame:
    """Requests that gave fewer pairs than the minimum, those without any included."""
    counted = pairs_per_request(dialogue_rows, options).select("request_id", "pairs")
    return (
        requests.join(counted, "request_id", "left")
        .withColumn("pairs", F.coalesce("pairs", F.lit(0)))
        .where(F.col("pairs") < options.min_pairs)
    )
