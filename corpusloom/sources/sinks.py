"""Writers. Each adds files to a directory, so a failed task leaves nothing half written.

With `order` the rows are range-partitioned and sorted, so that the files, read by name, hold them in that order; no task
sorts more than its range. Keys should tell rows apart: rows of equal keys stay together in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import non_empty, strip
from corpusloom.options import RecordOptions


def corpus_block(plain: Column, url: Column, date: Column, guide_title: Column) -> Column:
    """Header lines, text, a rule and blank lines."""
    return F.concat(
        F.concat_ws(
            "\n",
            F.concat(
                F.lit("Guide Title: "),
                F.coalesce(non_empty(guide_title), F.lit(fv.UNKNOWN_TITLE)),
            ),
            F.concat(F.lit("Source URL: "), url),
            F.concat(F.lit("Guide Date: "), non_empty(date)),
        ),
        F.lit("\n\n"),
        strip(plain),
        F.lit("\n\n" + fv.BLOCK_RULE + fv.BLOCK_PADDING),
    )


# Files are named by five digits, so names of more partitions no longer sort like their numbers.
MOST_FILES = 99_999


def in_order(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in ranges of the keys, each sorted; NULL keys come first."""
    keys = [F.col(k).asc_nulls_first() if isinstance(k, str) else k for k in order]
    if int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) > MOST_FILES:
        ranged = rows.repartitionByRange(MOST_FILES, *keys)
    else:
        ranged = rows.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def _write_text(rows: DataFrame, text: Column, path: str, mode: str, order: Sequence[str | Column]) -> None:
    ordered = in_order(rows, order) if order else rows
    ordered.select(text.alias("value")).write.mode(mode).text(path)


def write_corpus_blocks(
    blocks: DataFrame, path: str, column: str = "block", mode: str = "append", order: Sequence[str | Column] = ()
) -> None:
    """The blocks one after the other. The writer ends each row with a line break, so the
    last one of the padding is left to it."""
    body = F.substring(column, F.lit(1), F.length(column) - 1)
    _write_text(blocks, body, path, mode, order)


def write_jsonl(
    record_rows: DataFrame, path: str, column: str = "record", mode: str = "append", order: Sequence[str | Column] = ()
) -> None:
    _write_text(record_rows, F.col(column), path, mode, order)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the files under `path`, in the order of file names: line_no (from 1), value.

    Files are read in splits. Each task numbers its own lines, and what lies before a split comes from a table with one row
    per split, so no task sees all lines.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path, lineSep="\n").select(
        meta["file_name"].alias("file"),
        meta["file_block_start"].alias("start"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    splits = lines.groupBy("file", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file", "start", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(before, ["file", "start"]).select((F.col("id") + F.col("shift") + 1).alias("line_no"), "value")


def quarantine_entry(
    url: Column,
    guide_title: Column,
    prompt: Column,
    response_head: Column,
    total_len: Column,
    options: RecordOptions = RecordOptions(),
) -> Column:
    """A readable log entry for an answer that gave no record."""
    rule, line = "=" * 80, "-" * 80
    return F.concat(
        F.lit(f"{rule}\nURL: "),
        url,
        F.lit("\nGuide Title: "),
        guide_title,
        F.lit(f"\n{line}\n"),
        F.when(
            prompt != "",
            F.concat(F.lit(f"FINAL PROMPT SENT TO MODEL:\n{line}\n"), prompt, F.lit(f"\n{line}\n\n")),
        ).otherwise(F.lit("")),
        F.lit("INVALID MODEL RESPONSE:\n"),
        response_head,
        F.when(
            total_len > options.logged_chars,
            F.concat(
                F.lit("\n... [Truncated. Total length: "), total_len.cast("string"), F.lit(" chars]\n")
            ),
        ).otherwise(F.lit("")),
        F.lit(f"\n{rule}\n\n"),
    )


def write_quarantine(
    entries: DataFrame, path: str, column: str = "entry", mode: str = "append", order: Sequence[str | Column] = ()
) -> None:
    _write_text(entries, F.col(column), path, mode, order)
