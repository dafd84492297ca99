"""Resume as a stream: each URL is passed on once, over any number of runs."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for `name` under the folder the cluster shares for checkpoints.

    Only on a local master without one, as in tests, a temporary folder is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpusloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_url_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """New files under `path`, a directory or a glob, with at least a `url` column."""
    return spark.readStream.schema(schema).parquet(path)


def _once_per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.drop_duplicates("url")


def new_urls(urls: DataFrame, ingest_time: str | None = None, horizon: str | None = None) -> DataFrame:
    """The first row of each URL.

    A stream is not combined before its shuffle, so repeats are dropped within each Arrow batch
    first; a URL that fills a third of the input reaches its task once per batch of rows.

    The state grows with the number of URLs. With an ingest time and a horizon, URLs older
    than the horizon are forgotten, which bounds the state of an unbounded crawl.
    """
    fewer = urls.mapInPandas(_once_per_batch, urls.schema)
    if ingest_time and horizon:
        return fewer.withWatermark(ingest_time, horizon).dropDuplicatesWithinWatermark(["url"])
    return fewer.dropDuplicates(["url"])


def run_available(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Process what is there, commit it with the state, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(sink)
    )
    query.awaitTermination()
    return query


def incremental_urls(spark: SparkSession, source: str, schema: str, folder: str) -> DataFrame:
    """One run of the resume stream from `source`; returns what the sink holds by now."""
    sink = f"{folder}/urls"
    run_available(
        new_urls(read_url_stream(spark, source, schema).select("url")), sink, f"{folder}/checkpoint"
    )
    return spark.read.schema("url string").parquet(sink).where(F.col("url").isNotNull())


def recent_urls(
    spark: SparkSession, source: str, schema: str, folder: str, horizon: str, ingest_time: str = "ingest_time"
) -> StreamingQuery:
    """One run that passes on each URL once within the horizon of its first row; its sink is `{folder}/recent`.

    After each batch the watermark is the latest ingest time less the horizon. Rows older than it come too late and go; a URL whose
    first row is that old is forgotten with its state, and passes again when it comes again.
    """
    rows = read_url_stream(spark, source, schema).select("url", ingest_time)
    found = new_urls(rows, ingest_time, horizon)
    return run_available(found, f"{folder}/recent", f"{folder}/recent-checkpoint")
