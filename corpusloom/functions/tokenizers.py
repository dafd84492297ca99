"""A user's tokenizer as a column function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import functions as F


def plugged_tokens(load: Callable[[], Callable[[str], int]]):
    """`load()` runs once per Python worker and returns text -> number of tokens.

    Empty and NULL texts count 0. Only the text column crosses to Python, in Arrow batches.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenize = load()
        for batch in batches:
            yield batch.map(lambda text: tokenize(text) if text else 0).astype("int64")

    return count
