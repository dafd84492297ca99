"""Link lists and the state of processed links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixed_values as fv
from corpusloom.functions.text import strip


def read_markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per link file: file, text. A path without files gives no rows."""
    empty = spark.createDataFrame([], "file string, text string")
    if not path_exists(spark, path):
        return empty
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")
    )


def links_of(files: DataFrame) -> DataFrame:
    """Every http link of files(file, text), in order; images are skipped."""
    found = F.when(
        F.contains(F.col("text"), F.lit("](http")),
        F.filter(F.regexp_extract_all("text", F.lit(fv.LINK_TARGET), F.lit(1)), lambda url: url != ""),
    )
    return files.select("file", F.posexplode(found).alias("pos", "url"))


def unique_links(links: DataFrame) -> DataFrame:
    """Each URL once, with the first place it occurs. Map-side combined."""
    return (
        links.groupBy("url")
        .agg(F.min(F.struct("file", "pos")).alias("first"))
        .select("url", F.col("first.file").alias("file"), F.col("first.pos").alias("pos"))
    )


def processed_links(state_lines: DataFrame, column: str = "value") -> DataFrame:
    """State lines, one URL per line, to a distinct set."""
    return (
        state_lines.select(strip(F.col(column)).alias("url"))
        .where(F.col("url") != "")
        .distinct()
    )


def read_processed_links(spark: SparkSession, path: str) -> DataFrame:
    """The state under `path`; no state yet gives no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "url string")
    return processed_links(spark.read.text(path))


def append_processed_links(urls: DataFrame, path: str) -> None:
    """Add URLs to the state. Call it after the output write has been committed."""
    urls.select("url").distinct().write.mode("append").text(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return files is not None and len(files) > 0
