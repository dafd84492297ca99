"""Model answers: text, escapes, parsing and validity. Column in, column out.

Objects are read and written by Python's JSON in Arrow batches, as the readers of SQL sort the keys of nested objects and reject
repeated keys and NaN: keys keep their order, the last of repeated ones wins at the place of the first, NaN stays.

An Arrow batch, which Spark bounds by its number of rows, becomes Python objects some rows at a time, and these go back as batches of their
own. So a worker holds one batch and the objects of a few MB of text, however large the table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from corpusloom import fixed_values as fv
from corpusloom.functions.text import non_empty, strip, tokens

TURNS = "array<struct<role:string,content:string>>"


def response_text(text: Column, candidates: Column | None = None) -> Column:
    """The answer text, else the joined candidate parts; without surrounding fences.

    `candidates` is ARRAY<STRUCT<parts: ARRAY<STRUCT<text>>>>.
    """
    answer = text
    if candidates is not None:
        pieces = F.flatten(F.transform(candidates, lambda c: F.transform(c["parts"], lambda p: p["text"])))
        answer = F.coalesce(non_empty(text), F.array_join(pieces, ""), F.lit(""))
    unopened = F.regexp_replace(strip(answer), fv.OPENING_FENCE, "")
    return strip(F.regexp_replace(unopened, fv.CLOSING_FENCE, ""))


def sanitize_escapes(text: Column) -> Column:
    """Drop backslashes of escapes that JSON does not know."""
    return F.regexp_replace(F.regexp_replace(text, fv.BAD_ESCAPE, ""), fv.BAD_UNICODE_ESCAPE, "u")


def turns_of(item: Column) -> Column:
    """`conversations` of a dialogue object as ARRAY<STRUCT<role, content>>."""
    return F.from_json(item, f"conversations {TURNS}")["conversations"]


_FAILED = object()
_LONE_SURROGATE = re.compile("[\ud800-\udfff]")


def _parsed(text: str) -> Any:
    """The value of a text that is one JSON value, else `_FAILED`."""
    try:
        return json.loads(text)
    except (ValueError, RecursionError):
        return _FAILED


def _readable(text: str) -> tuple[str, Any]:
    """The text itself if it parses, else with its escapes repaired, and its value."""
    value = _parsed(text)
    if value is _FAILED and "\\" in text:
        text = re.sub(fv.BAD_UNICODE_ESCAPE, "u", re.sub(fv.BAD_ESCAPE, "", text))
        value = _parsed(text)
    return text, value


def _written(value: Any) -> str:
    """JSON text; a surrogate without its other half, which UTF-8 cannot hold, becomes U+FFFD."""
    return _LONE_SURROGATE.sub("\ufffd", json.dumps(value, ensure_ascii=False))


def _is_dialogue(item: Any) -> bool:
    """An object whose `conversations` is a list of two or more objects with both keys.

    Only the presence of `role` and `content` counts, not their values.
    """
    turns = item.get("conversations") if isinstance(item, dict) else None
    return (
        isinstance(turns, list)
        and len(turns) >= 2
        and all(isinstance(turn, dict) and "role" in turn and "content" in turn for turn in turns)
    )


def _dialogues_in(answer: str) -> list[str]:
    answer, value = _readable(answer)
    if value is _FAILED:
        lines = [line.strip() for line in answer.splitlines()]
        entries = [_readable(line)[1] for line in lines if line.startswith("{") and line.endswith("}")]
    else:
        entries = value if isinstance(value, list) else [value]
    return [_written(entry) for entry in entries if _is_dialogue(entry)]


PIECE_BYTES = 1 << 20


def _pieces(*columns: pa.Array) -> Iterator[tuple[pa.Array, ...]]:
    """Equally long columns in slices that hold about PIECE_BYTES of the first one; one row at least."""
    rows = len(columns[0])
    step = max(1, rows * PIECE_BYTES // max(columns[0].nbytes, 1))
    for lo in range(0, rows, step):
        yield tuple(c.slice(lo, step) for c in columns)


@F.arrow_udf(ArrayType(StringType()))
def dialogue_items(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """ARRAY<STRING> of the valid dialogue objects in an answer; NULL for NULL.

    A JSON list gives its entries, a single object itself, anything else its lines that
    are objects of their own.
    """
    for texts in batches:
        for (piece,) in _pieces(texts):
            yield pa.array([None if t is None else _dialogues_in(t) for t in piece.to_pylist()], pa.list_(pa.string()))


def answer_tokens(turns: Column) -> Column:
    """Tokens of all assistant turns."""
    return F.aggregate(
        F.filter(turns, lambda t: t["role"] == "assistant"),
        F.lit(0).cast("bigint"),
        lambda total, t: total + F.coalesce(tokens(t["content"]), F.lit(0)),
    )


def _enriched(item: str, url: str | None, lang: str, date: str | None, n: int) -> str:
    record = json.loads(item)
    record["url"] = url or ""
    record["lang"] = lang
    if date:
        record["date"] = date
    record["answer_tokens"] = int(n)
    return _written(record)


@F.arrow_udf(StringType())
def record_json(
    batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]],
) -> Iterator[pa.Array]:
    """The dialogue object with its metadata set, from (item, url, lang, date, tokens); other keys are kept, all of them in their order.

    A key that is there already keeps its place. A date is written only if there is one.
    """
    for columns in batches:
        for piece in _pieces(*columns):
            rows = zip(*[c.to_pylist() for c in piece], strict=True)
            yield pa.array([_enriched(*row) for row in rows], pa.string())
