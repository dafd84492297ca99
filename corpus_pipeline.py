"""From raw documents to packed token rows: five stages, each a table that the next one reads.

Every stage works on all rows its predecessor kept and, but for the last, returns the columns of `documents`.
Stages with several passes write their in-between tables in the shared folder. SQL cannot express the hashed n-gram scores,
MinHash candidates or tokens, so `ORACLE_SQL` is None and tests hold the rows against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm.mixing import expanded
from corpusloom.llm.near_dedup import NearOptions, one_of_each
from corpusloom.llm.packing import packed
from corpusloom.llm.rules import passing
from corpusloom.llm.store import cut, table
from corpusloom.llm.winnowing import uncontaminated

ORACLE_SQL = None

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Stages on word shingles take pairs from a similarity of 0.8 on; the 0.85 of NearOptions is that of op3_near_dedup alone.
NEAR = NearOptions(percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return passing(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, linked from a similarity of 0.8 on, the document of the smallest id stays."""
    return one_of_each(docs, options=NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document taken twice is two rows."""
    return expanded(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in rows of one length, with segment lengths and position resets."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
