"""Which links are new, done, or finished by this run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending_links(links: DataFrame, processed: DataFrame) -> DataFrame:
    """Links that are not in the state; their position is kept."""
    return links.join(processed.select("url"), "url", "left_anti")


def done_links(links: DataFrame, processed: DataFrame) -> DataFrame:
    return links.join(processed.select("url"), "url", "left_semi")


def run_summary(links: DataFrame, processed: DataFrame) -> DataFrame:
    """All links, new links and known links, in one row."""
    known = processed.select("url").distinct().withColumn("known", F.lit(True))
    return links.join(known, "url", "left").agg(
        F.count(F.lit(1)).alias("total_links"),
        F.count_if(F.col("known").isNull()).alias("new_links"),
        F.count_if(F.col("known").isNotNull()).alias("known_links"),
    )


def finished_urls(
    pending: DataFrame, record_counts: DataFrame, mark_empty: bool = False
) -> DataFrame:
    """URLs to add to the state: those with a record, or with `mark_empty` all of them."""
    if mark_empty:
        return pending.select("url").distinct()
    with_records = record_counts.where(F.col("url").isNotNull() & (F.col("records") > 0))
    return pending.select("url").distinct().join(with_records.select("url"), "url", "left_semi")
