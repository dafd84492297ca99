"""Main text of web pages: blocks by markup, and lines shared with the page of the nearest URL deleted.

1. Every page is cut into blocks, its lines (`page_blocks.py`): those of an article, those of menus, footers, forms and the like by
   tag, class, id or role, and open ones, about which the markup says nothing.
2. Pages are put in order of host and URL path, a page beside the pages of the nearest paths. The order comes from a
   range-partitioned sort of small rows (a hash per line), so a host that holds a third of all pages is many tasks. Equal line
   sequences of a host are one row, whatever their number.
3. The order is cut into stretches of `STRETCH` pages, each with the page before and the page after. In a stretch, neighbours of one
   host are aligned by a longest common subsequence of their lines. Of both neighbours the one with the longer common start of
   the path counts, the earlier one of equals; a page that shares nearly all its text (`COPY`) is a copy and shows nothing about
   the site's template, so the other one counts then.
4. Lines that a page shares with its neighbour are deleted, but for those that markup puts into an article: copies of a page and
   passages that many articles quote are text, not template. What is left of open lines is the text of pages without an article;
   of pages with one it is the article, after an open h1 if the article has none.

The alignment is bit-parallel: one operation on an integer of a page's length per line of the other page. Above `TABLE_BYTES` it
divides (Hirschberg), so memory stays linear in the longest page. Only decisions that delete a line meet the pages again; Spark
broadcasts them below the session's limit, and beyond it pages move once.

Defined: NULL and empty pages have an empty text and no lines; a NULL URL, or one without a host, has no neighbours. Hosts
are compared in lower case; query and fragment do not count. Character references are decoded, those without a semicolon as browsers
do; white space is what Unicode calls so, and `<br>` is white space. Rows that are equal in host and lines share the decision, also
where page_ids repeat. Columns other than the page's stay.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions.text import let
from corpusloom.llm.merkle import placed
from corpusloom.llm.page_blocks import ARTICLE, CHROME, OPEN, Block, blocks_of
from corpusloom.llm.store import cut, free_name

STRETCH = 64
PAGES = 256
COPY = 0.9
TABLE_BYTES = 16 << 20
HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


@dataclass(frozen=True)
class PageOptions:
    html: str = "html"
    url: str = "url"
    stretch: int = STRETCH
    copy: float = COPY


def _rows(a: list, b: list) -> Iterator[int]:
    """For each line of `a` a row of bits: bit j is clear where the common subsequence grows at line j of `b`."""
    places: dict = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | (1 << j)
    full = row = (1 << len(b)) - 1
    for line in a:
        seen = row & places.get(line, 0)
        row = ((row + seen) | (row - seen)) & full
        yield row


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of all of `a` with each start of `b`."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    bits = np.frombuffer((~row & ((1 << len(b)) - 1)).to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    return np.concatenate([[0], np.cumsum(np.unpackbits(bits, bitorder="little")[: len(b)])])


def common_lines(a: list, b: list, table_bytes: int = TABLE_BYTES) -> list[tuple[int, int]]:
    """Pairs of indexes of one longest common subsequence, ascending."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    tail = 0
    while tail < min(len(a), len(b)) - lo and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    start = [(k, k) for k in range(lo)]
    end = [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]
    a, b = a[lo : len(a) - tail], b[lo : len(b) - tail]
    # Lines that the other side lacks are in no alignment.
    in_a, in_b = set(a), set(b)
    at_a, at_b = [k for k, x in enumerate(a) if x in in_b], [k for k, x in enumerate(b) if x in in_a]
    a, b = [a[k] for k in at_a], [b[k] for k in at_b]
    return start + [(lo + at_a[i], lo + at_b[j]) for i, j in _aligned(a, b, table_bytes)] + end


def _aligned(a: list, b: list, table_bytes: int) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    if len(a) * (len(b) // 8 + 40) > table_bytes:
        half = len(a) // 2
        ahead = _lengths(a[:half], b)
        behind = _lengths(a[half:][::-1], b[::-1])[::-1]
        at = int((ahead + behind).argmax())
        later = _aligned(a[half:], b[at:], table_bytes)
        return _aligned(a[:half], b[:at], table_bytes) + [(half + i, at + j) for i, j in later]
    rows, found = list(_rows(a, b)), []
    j = len(b) - 1
    for i in range(len(a) - 1, -1, -1):
        # Left of and at j the subsequence last grows at the highest clear bit; it is line i's own if the row before lacks it.
        clear = ~rows[i] & ((1 << (j + 1)) - 1)
        if not clear:
            break
        top = clear.bit_length() - 1
        before = ~rows[i - 1] & ((1 << (j + 1)) - 1) if i else 0
        if before.bit_count() < clear.bit_count():
            while a[i] != b[top]:
                top -= 1
            found.append((i, top))
            j = top - 1
    return found[::-1]


def _digest(blocks: list[Block]) -> tuple[list[int], bytes]:
    """A 64-bit hash per line and a 128-bit one of all lines with their zones."""
    lines, whole = [], blake2b(digest_size=16)
    for b in blocks:
        line = blake2b(b.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        whole.update(line + bytes([b.zone, b.heading]))
        lines.append(int.from_bytes(line[:8], "little", signed=True))
    return lines, whole.digest()


def _common_start(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def _decided(pages: list[dict], copy: float) -> list[list[int]]:
    """For each page, in order of host and path, the open lines it shares with the neighbour that counts."""
    shared: list[list[tuple[int, list[int]]]] = [[] for _ in pages]
    for k in range(len(pages) - 1):
        a, b = pages[k], pages[k + 1]
        if not a["host"] or a["host"] != b["host"] or a["pos"] + 1 != b["pos"]:
            continue
        pairs = common_lines(a["lines"], b["lines"])
        near = _common_start(a["path"], b["path"])
        for page, lines, other in ((a, [i for i, _ in pairs], k), (b, [j for _, j in pairs], k + 1)):
            if sum(page["chars"][i] for i in lines) < copy * sum(page["chars"]):
                shared[other].append((near, lines))
    chosen = [max(s, key=lambda x: x[0])[1] if s else [] for s in shared]
    return [[i for i in lines if page["zones"][i] == OPEN] for page, lines in zip(pages, chosen)]


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some pages at a time, so that their blocks take little memory."""
    for batch in batches:
        for lo in range(0, batch.num_rows, PAGES):
            yield batch.slice(lo, PAGES)


def _keys(df: DataFrame, options: PageOptions) -> DataFrame:
    """One small row per page: host, path, the digest of its lines, a hash, a length and a zone per line."""
    url = F.col(options.url)
    given = df.select(
        F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)).alias("host"),
        F.regexp_extract(F.coalesce(url, F.lit("")), PATH, 1).alias("path"),
        F.col(options.html).alias("html"),
    )
    schema = "host string, path string, digest binary, lines array<bigint>, chars array<int>, zones array<tinyint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["host", "path", "digest", "lines", "chars", "zones"]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int8())]
        for batch in _sliced(batches):
            found = []
            for host, path, html in zip(*(batch.column(k).to_pylist() for k in range(3))):
                blocks = blocks_of(html)
                lines, digest = _digest(blocks)
                found.append((host, path, digest, lines, [len(b.text) for b in blocks], [b.zone for b in blocks]))
            arrays = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return given.mapInArrow(run, schema)


def shared_lines(df: DataFrame, options: PageOptions) -> DataFrame:
    """(host, digest, shared): for each line sequence of a host the indexes of the open lines that its neighbour shares, if any."""
    keys = _keys(df, options).where("host <> '' AND size(lines) > 0")
    one = keys.groupBy("host", "digest").agg(
        F.min("path").alias("path"), *[F.first(c).alias(c) for c in ("lines", "chars", "zones")]
    )
    order = [F.col("host"), F.col("path"), F.col("digest")]
    ranked = placed(one.withColumn("all_pages", F.lit(0)), "all_pages", order, "page-order")
    # The first and the last page of a stretch go to the stretch beside it too.
    step, pos = options.stretch, F.col("pos")
    home = F.floor(pos / step)
    also = F.when(pos % step == 0, home - 1).when(pos % step == step - 1, home + 1)
    dealt = ranked.withColumn("stretch", F.explode(F.array_compact(F.array(home, also)))).drop("all_pages", "size")
    kinds = pa.schema([("host", pa.string()), ("digest", pa.binary()), ("shared", pa.list_(pa.int32()))])
    copy = options.copy

    def run(group: pa.Table) -> pa.Table:
        pages = sorted(group.to_pylist(), key=lambda p: p["pos"])
        found = zip(pages, _decided(pages, copy))
        own = [
            {"host": p["host"], "digest": p["digest"], "shared": s} for p, s in found if s and p["pos"] // step == p["stretch"]
        ]
        return pa.Table.from_pylist(own, kinds)

    return dealt.groupBy("stretch").applyInArrow(run, "host string, digest binary, shared array<int>")


def _main_text(lines: Column, shared: Column) -> Column:
    """The text of a page from its lines (text, zone, heading; the text of chrome is NULL) without the shared ones."""

    def written(left: Column) -> Column:
        of_article = F.filter(left, lambda b: b["zone"] == ARTICLE)
        first = F.array_position(F.transform(left, lambda b: b["zone"] == ARTICLE), True) - 1
        titled = F.exists(of_article, lambda b: b["heading"])
        title = F.filter(F.slice(left, F.lit(1), F.greatest(first, F.lit(0)).cast("int")), lambda b: b["heading"] & ~titled)
        blocks = F.when(F.size(of_article) > 0, F.concat(title, of_article)).otherwise(left)
        return F.array_join(F.transform(blocks, lambda b: b["text"]), "\n")

    places = F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1))
    others = F.transform(F.array_except(places, shared), lambda k: F.get(lines, k))
    kept = F.when(shared.isNull(), lines).otherwise(others)
    return let(F.filter(kept, lambda b: b["text"].isNotNull()), written)


def _parsed(df: DataFrame, html: str, names: dict[str, str]) -> DataFrame:
    """`df` without its page, with the page's lines and their digest."""
    line = "array<struct<text: string, zone: int, heading: boolean>>"
    schema = StructType(
        [f for f in df.schema.fields if f.name != html]
        + StructType.fromDDL(f"{names['digest']} binary, {names['lines']} {line}").fields
    )
    at = df.columns.index(html)
    kind = pa.list_(pa.struct([("text", pa.string()), ("zone", pa.int32()), ("heading", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            digests, lines = [], []
            for page in batch.column(at).to_pylist():
                blocks = blocks_of(page)
                digests.append(_digest(blocks)[1])
                lines.append([(b.text if b.zone != CHROME else None, b.zone, b.heading) for b in blocks])
            others = [column for k, column in enumerate(batch.columns) if k != at]
            added = [pa.array(digests, pa.binary()), pa.array(lines, kind)]
            yield pa.RecordBatch.from_arrays([*others, *added], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def with_main_text(df: DataFrame, options: PageOptions = PageOptions()) -> DataFrame:
    """`df` with `text`, `n_chars` (code points), `n_lines` and `n_deleted` (open lines that the neighbour shares) in place of its
    page; earlier columns of these names go."""
    made = {"text", "n_chars", "n_lines", "n_deleted"} - {options.html, options.url}
    kept = df.drop(*made)
    names = {n: free_name(df, f"page_{n}") for n in ("host", "site", "digest", "lines", "key", "shared")}
    decisions = cut(shared_lines(df, options), "page-shared").select(
        F.col("host").alias(names["site"]), F.col("digest").alias(names["key"]), F.col("shared").alias(names["shared"])
    )
    host = F.lower(F.regexp_extract(F.coalesce(F.col(options.url), F.lit("")), HOST, 1))
    pages = _parsed(kept.withColumn(names["host"], host), options.html, names)
    same = (F.col(names["host"]) == F.col(names["site"])) & (F.col(names["digest"]) == F.col(names["key"]))
    lines, shared = F.col(names["lines"]), F.col(names["shared"])
    # A generator, so that the text is put together once for itself and its length.
    texts = pages.join(decisions, same, "left").select("*", F.explode(F.array(_main_text(lines, shared))).alias("text"))
    return texts.select(
        *[c for c in kept.columns if c != options.html],
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
        F.size(lines).alias("n_lines"),
        F.when(shared.isNotNull(), F.size(shared)).otherwise(0).alias("n_deleted"),
    )
