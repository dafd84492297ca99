"""Streams whose results are tables keyed by the batch: a batch that is run again overwrites what it wrote before.

A stream commits a batch after its sink has returned, so a run that dies in between runs that batch once more, with the same
input and id. Each batch writes `batch=<id>` of every table by overwriting it, and a reader sees only batches that a
marker file names, which is written last. So whatever dies where, each batch is in the tables once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom import fixed_values as fv
from corpusloom.operators.exact_chunks import Load
from corpusloom.operators.prompts import unique_requests
from corpusloom.options import ChunkOptions, StructureOptions
from corpusloom.plans.documents import document_prompts
from corpusloom.sources.fetched import documents_from_html
from corpusloom.sources.links import path_exists

Tables = Callable[[DataFrame], dict[str, DataFrame]]


def write_batch(tables: dict[str, DataFrame], out: str, batch: int) -> None:
    """All tables of a batch, then its marker."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch}")
        spark = rows.sparkSession
    done = spark.createDataFrame([(batch,)], "batch bigint").coalesce(1)
    done.write.mode("overwrite").parquet(f"{out}/_done/{batch}")


def run_batches(stream: DataFrame, tables_of: Tables, out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there in batches and stop. `tables_of(rows)` gives the tables of a batch by name."""

    def write(rows: DataFrame, batch: int) -> None:
        write_batch(tables_of(rows), out, batch)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_batches(spark: SparkSession, out: str, name: str, schema: str) -> DataFrame:
    """A table over all finished batches, without the rows of one that has no marker yet."""
    if not path_exists(spark, f"{out}/_done/*/_SUCCESS"):
        return spark.createDataFrame([], f"{schema}, batch bigint")
    done = spark.read.schema("batch bigint").parquet(f"{out}/_done/*")
    rows = spark.read.schema(f"{schema}, batch bigint").parquet(f"{out}/{name}")
    return rows.join(done, "batch", "left_semi").select(*rows.columns)


PROMPTS = (
    "request_id string, doc_id bigint, url string, date string, guide_title string, chunk_no int, part_no int, n_parts int, "
    "kind string, prompt string"
)


def page_prompts_of(
    chunks: ChunkOptions = ChunkOptions(),
    structures: StructureOptions = StructureOptions(),
    template: str = fv.DEFAULT_TEMPLATE,
    tokenizer: Load | None = None,
) -> Tables:
    """pages(page_id, url, html) of a batch to its prompts, each request once."""

    def tables(pages: DataFrame) -> dict[str, DataFrame]:
        docs = documents_from_html(pages).withColumnRenamed("page_id", "doc_id")
        found = unique_requests(document_prompts(docs, chunks, structures, template, tokenizer))
        columns = [part.split()[0] for part in PROMPTS.split(", ")]
        return {"prompts": found.select(*[F.col(c) for c in columns])}

    return tables
