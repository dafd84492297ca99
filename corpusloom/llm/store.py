"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a temporary folder only on a local master without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="corpusloom-")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it back: what follows does not depend on its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or one like it that no column of `df` has, upper and lower case taken as equal."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_parts(df: DataFrame, text: str = "text", part_bytes: int = 4 << 20) -> int:
    """How many parts of about `part_bytes` the texts make; one pass over all of them."""
    total = df.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    return max(1, -(-total // part_bytes))
