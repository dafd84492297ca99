"""Connected components of a table of links, by stars: every node ends as a neighbour of its smallest one.

Each round links the larger neighbours of a node to its smallest neighbour, then the smaller ones. The number
of rounds grows with the logarithm of the longest chain. Smallest neighbours are combined in each task
before the shuffle, so a node with very many links is no hot group; each round is written as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.store import cut


def _larger_to_smallest(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("least", "u"))
    found = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return found.filter("u != v").distinct()


def _smaller_to_smallest(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.select("u", F.col("least").alias("v"))
    return moved.filter("u != v").unionByName(own).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: a, b. One row `node, component` for every node but the smallest of each component."""
    links = cut(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        "links",
    )
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        links = cut(_smaller_to_smallest(_larger_to_smallest(links)), "links")
