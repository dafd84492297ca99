"""Stored fetch responses and crawled pages to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.html import html_title, html_to_markdown

FETCHED = "title string, url string, content string"


def unwrap_response(kind: Column, raw: Column, url: Column) -> Column:
    """STRUCT<title, url, content> of a stored response.

    `text`: the body is the content. `reader`: JSON, possibly inside `data`, that may state
    its own title and URL. `converter`: JSON whose `markdown` is the content.
    """
    data = F.from_json(F.coalesce(F.get_json_object(raw, "$.data"), raw), FETCHED)
    empty = F.lit("")
    title = F.when(kind == "reader", F.coalesce(data["title"], empty)).otherwise(empty)
    content = (
        F.when(kind == "reader", F.coalesce(data["content"], empty))
        .when(kind == "converter", F.coalesce(F.get_json_object(raw, "$.markdown"), empty))
        .otherwise(raw)
    )
    own_url = F.when(kind == "reader", F.coalesce(data["url"], url)).otherwise(url)
    return F.struct(title.alias("title"), own_url.alias("url"), content.alias("content"))


def documents_from_html(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) to docs(page_id, url, title, content) in markdown."""
    return pages.select(
        "page_id",
        "url",
        html_title(F.col("html")).alias("title"),
        html_to_markdown(F.col("html")).alias("content"),
    )


def one_capture(pages: DataFrame) -> DataFrame:
    """Of several captures of a URL the one with the largest page_id; a NULL URL is one URL.

    Chosen on keys alone, combined before the shuffle; texts only meet the chosen ids.
    """
    chosen = pages.groupBy("url").agg(F.max("page_id").alias("page_id")).select("page_id")
    return pages.join(chosen.distinct(), "page_id", "left_semi").dropDuplicates(["page_id"])


def drop_empty(docs: DataFrame, column: str = "content") -> DataFrame:
    """Rows whose text is not NULL and not empty.

    Done by a generator, so an expensive column is computed once, not again for the filter.
    """
    others = [c for c in docs.columns if c != column]
    kept = F.filter(F.array(F.col(column)), lambda t: t != "")
    return docs.select(*others, F.explode(kept).alias(column)).select(*docs.columns)
