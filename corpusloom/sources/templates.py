"""The prompt template: a text file if there is one, else the built-in text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from corpusloom import fixed_values as fv
from corpusloom.sources.links import path_exists


def read_template(spark: SparkSession, path: str | None, default: str = fv.DEFAULT_TEMPLATE) -> str:
    """The text of one small file; it becomes a literal of the plan."""
    if not path or not path_exists(spark, path):
        return default
    return spark.read.text(path, wholetext=True).first()[0]
