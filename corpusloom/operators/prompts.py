"""Prompts from parts: context and source text put into a template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.markdown import heading_context


def context(guide_title: Column, section: Column) -> Column:
    return F.concat_ws(
        "\n\n",
        F.when(guide_title != "", F.concat(F.lit("Guide Title: "), guide_title)),
        F.when(section != "", F.concat(F.lit("Section Hierarchy:\n"), section)),
    )


def prompt_text(template: Column, guide_title: Column, source: Column) -> Column:
    """Every `{context}` is replaced; the source text follows on a new line."""
    filled = F.replace(
        template, F.lit("{context}"), context(guide_title, heading_context(source))
    )
    return F.concat(filled, F.lit("\n"), source)


def request_id(*key: Column) -> Column:
    """A stable id, so that a repeated run gives the same request the same name."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("")) for k in key]), 256)


def prompts(parts: DataFrame, template: str = fv.DEFAULT_TEMPLATE) -> DataFrame:
    """parts(url, guide_title, chunk_no, part_no, text, ...) to one prompt per non-empty part.

    The id holds the whole prompt, so another template or text is another request.
    """
    return (
        parts.where(F.col("text") != "")
        .withColumn(
            "prompt", prompt_text(F.lit(template), F.col("guide_title"), F.col("text"))
        )
        .withColumn("request_id", request_id(F.col("url"), F.col("chunk_no"), F.col("part_no"), F.col("prompt")))
    )


def unique_requests(prompt_rows: DataFrame) -> DataFrame:
    """Each request once; equal ids mean equal prompts, so any of the rows will do. Combined before the shuffle."""
    others = [c for c in prompt_rows.columns if c != "request_id"]
    found = prompt_rows.groupBy("request_id").agg(F.min(F.struct(*others)).alias("_row"))
    return found.select("request_id", "_row.*").select(*prompt_rows.columns)
