"""Removal of long repeated word spans: a De Bruijn graph of word k-mers, compacted into paths.

Every run of `window` consecutive words is an edge of the graph, from its first `window` - 1 words to
its last. An edge that starts in two documents is repeated; its source is the place in the document
with the smallest id. Repeated edges that follow each other both in a document and at their source
lie on one path and are compacted into a span `(document, position, length, source, position there)`.
The words of each span are then compared with the words at its source coordinates.

How the work is spread:

1. Documents are dealt into parts of a few MB by a hash of id and text. Within a part each edge is
   kept once, so copies are combined before anything is sent.
2. The distinct edges of a part are sorted by hash and sent in blocks, a block for each range of hashes:
   differences of sorted hashes, document ids and positions, compressed. About eight bytes an edge.
3. Each range of hashes finds repeated edges and answers the parts that sent them with the source.
4. Parts join the answers with their texts, compact edges to spans and give them a digest of their words.
5. Distinct (source, length, digest) rows join the source texts. Spans whose words differ are dropped.
6. Parts join the spans with their texts and remove the covered words.

The exchange of texts by part is the same in steps 2, 4, 5 and 6 and is written once.

Defined cases: NULL or empty texts have no words and give an empty kept text. Rows of one id are
judged apart, never against each other. Rows with a NULL id lose words that a document with an id
has, and are never a source. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.blocks import covered, text_bytes, words_of
from corpusloom.llm.store import text_parts

Key = tuple[pa.Scalar, ...]
# Edges are known by whole 64-bit hashes; among 8e9 edges four in 1e10 meet other words by chance. Comparing words then drops the
# span, so such an edge can only stay unremoved, never remove words that are not repeated.
HASH_BITS = 64
NO_ID = np.iinfo(np.int64).max
PART_BYTES = 4 << 20
RANGE_BYTES = 12 << 20

_BLOCK = "range int, part int, n int, payload binary"
_SPAN = "part int, doc_row int, at int, n int, src_part int, src_id bigint, src_at int, digest binary"
_CHECK = ["src_part", "src_id", "src_at", "n", "digest"]
_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string"


def _pack(*columns: np.ndarray) -> bytes:
    """Equal-length columns as compressed byte planes."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(payload: bytes, n: int, *kinds) -> list[np.ndarray]:
    raw, found = zstandard.ZstdDecompressor().decompress(payload), []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        plane = np.frombuffer(raw, np.uint8, n * size, sum(len(f) * f.itemsize for f in found))
        found.append(np.ascontiguousarray(plane.reshape(size, n).T).view(kind).reshape(n))
    return found


@dataclass
class _Part:
    """The documents of a part in a fixed order, their edges, and the distinct edges sorted by hash."""

    ids: np.ndarray
    texts: pa.Array
    n_words: np.ndarray
    at: np.ndarray
    row: np.ndarray
    edge: np.ndarray
    distinct: np.ndarray
    first: np.ndarray

    @property
    def first_id(self) -> np.ndarray:
        return self.ids[self.row[self.first]]


def _rows(group: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """Ids and texts of a part, ordered by both so that every step sees the same order."""
    group = group.select(["doc_id", "text"]).combine_chunks()
    group = group.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    ids = group["doc_id"].fill_null(NO_ID).to_numpy().astype(np.int64)
    return ids, group["text"]


def _part(group: pa.Table, window: int) -> _Part:
    ids, texts = _rows(group)
    words = words_of(*text_bytes(texts))
    hashes, start = words.ngrams(window)
    hashes >>= np.uint64(64 - HASH_BITS)
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    opens = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
    edge = np.empty(len(ranked), np.int64)
    edge[order] = np.cumsum(opens) - 1
    row = words.doc[start]
    return _Part(
        ids, texts, np.diff(words.first), start - words.first[row], row, edge, ranked[opens], order[opens]
    )


def _range_cuts(distinct: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of `ranges` equal ranges of hashes begins in sorted hashes, and the end."""
    place = ((distinct >> np.uint64(HASH_BITS - 32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(place, np.arange(ranges + 1, dtype=np.uint64))


def _edges(window: int, ranges: int):
    def run(key: Key, group: pa.Table) -> pa.Table:
        part = _part(group, window)
        cuts = _range_cuts(part.distinct, ranges)
        ids, at = part.first_id, part.at[part.first].astype(np.uint32)
        found = []
        for number in np.flatnonzero(np.diff(cuts)):
            here = slice(cuts[number], cuts[number + 1])
            steps = np.diff(part.distinct[here], prepend=np.uint64(0))
            found.append((int(number), here.stop - here.start, _pack(steps, ids[here], at[here])))
        return pa.table(
            {
                "range": pa.array([f[0] for f in found], pa.int32()),
                "part": pa.array([key[0].as_py()] * len(found), pa.int32()),
                "n": pa.array([f[1] for f in found], pa.int32()),
                "payload": pa.array([f[2] for f in found], pa.binary()),
            }
        )

    return run


def _sources(key: Key, group: pa.Table) -> pa.Table:
    """Answers to the senders of edges of one range of hashes: which edges have a source of smaller id."""
    parts, sizes = group["part"].to_numpy(), group["n"].to_numpy()
    columns = [
        _unpack(payload.as_py(), n, np.uint64, np.int64, np.uint32)
        for payload, n in zip(group["payload"], sizes, strict=True)
    ]
    hashes = np.concatenate([np.cumsum(c[0]) for c in columns])
    ids, at = (np.concatenate([c[k] for c in columns]) for k in (1, 2))
    del columns
    ends = np.cumsum(sizes)
    order = np.argsort(hashes)
    ranked = hashes[order]
    begin = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    size = np.diff(np.append(begin, len(ranked)))
    many = size > 1
    member = order[np.repeat(many, size)]
    edge = np.repeat(np.arange(many.sum()), size[many])
    sender = np.searchsorted(ends, member, side="right")
    by = np.lexsort((at[member], parts[sender], ids[member], edge))
    source = member[by[np.searchsorted(edge, np.arange(many.sum()))]][edge]
    later = np.flatnonzero(ids[member] > ids[source])
    later = later[np.argsort(member[later])]
    member, source, sender = member[later], source[later], sender[later]
    inside = (member - (ends - sizes)[sender]).astype(np.uint32)
    src_part = parts[np.searchsorted(ends, source, side="right")].astype(np.int32)
    answered, opens, count = np.unique(sender, return_index=True, return_counts=True)
    payloads = []
    for lo, n in zip(opens, count, strict=True):
        own = slice(lo, lo + n)
        steps = np.diff(inside[own], prepend=np.uint32(0))
        payloads.append(_pack(steps, src_part[own], ids[source[own]], at[source[own]]))
    return pa.table(
        {
            "range": pa.array([key[0].as_py()] * len(answered), pa.int32()),
            "part": pa.array(parts[answered], pa.int32()),
            "n": pa.array(count, pa.int32()),
            "payload": pa.array(payloads, pa.binary()),
        }
    )


def _spans(window: int, ranges: int):
    def run(key: Key, group: pa.Table, answers: pa.Table) -> pa.Table:
        part_no = key[0].as_py()
        part = _part(group, window)
        cuts = _range_cuts(part.distinct, ranges)
        src_part = np.full(len(part.distinct), part_no, np.int32)
        src_id, src_at = part.first_id.copy(), part.at[part.first].astype(np.int64)
        for number, n, payload in zip(answers["range"], answers["n"], answers["payload"], strict=True):
            steps, parts, ids, at = _unpack(payload.as_py(), n.as_py(), np.uint32, np.int32, np.int64, np.uint32)
            where = cuts[number.as_py()] + np.cumsum(steps, dtype=np.int64)
            src_part[where], src_id[where], src_at[where] = parts, ids, at
        edge = part.edge
        repeated = np.flatnonzero(part.ids[part.row] > src_id[edge])
        edge, row, at = edge[repeated], part.row[repeated], part.at[repeated]
        from_part, from_id, from_at = src_part[edge], src_id[edge], src_at[edge]
        follows = (
            (row[1:] == row[:-1]) & (at[1:] == at[:-1] + 1) & (from_at[1:] == from_at[:-1] + 1)
            & (from_id[1:] == from_id[:-1]) & (from_part[1:] == from_part[:-1])
        )
        opens = np.flatnonzero(np.concatenate([[True], ~follows])) if len(row) else np.zeros(0, np.int64)
        n = np.diff(np.append(opens, len(row)))
        at = at[opens]
        digests = _digests(part.texts, row[opens], at, at + n + window - 1)
        return pa.table(
            {
                "part": pa.array(np.full(len(opens), part_no), pa.int32()),
                "doc_row": pa.array(row[opens], pa.int32()),
                "at": pa.array(at, pa.int32()),
                "n": pa.array(n, pa.int32()),
                "src_part": pa.array(from_part[opens], pa.int32()),
                "src_id": pa.array(from_id[opens], pa.int64()),
                "src_at": pa.array(from_at[opens], pa.int32()),
                "digest": pa.array(digests, pa.binary()),
            }
        )

    return run


def _digests(texts: pa.Array, rows, starts, ends) -> list[bytes]:
    """Digests of word ranges; `rows` is in order, so each text is split once."""
    found, last, words = [], -1, []
    for row, start, end in zip(rows, starts, ends, strict=True):
        if row != last:
            words, last = texts[int(row)].as_py().encode().split(), row
        found.append(blake2b(b" ".join(words[start:end]), digest_size=12).digest())
    return found


def _unlike(window: int):
    """Claimed spans whose words differ from those at their source coordinates."""

    def run(key: Key, group: pa.Table, claims: pa.Table) -> pa.Table:
        ids, texts = _rows(group)
        want = claims.sort_by("src_id").select(_CHECK)
        src_id = want["src_id"].to_numpy()
        start, n = want["src_at"].to_numpy(), want["n"].to_numpy()
        found = np.zeros(len(src_id), bool)
        # An id may have several rows; a claim holds if one of them has the words.
        low, high = np.searchsorted(ids, src_id, "left"), np.searchsorted(ids, src_id, "right")
        given = want["digest"].to_pylist()
        for copy in range(int((high - low).max(initial=0))):
            left = np.flatnonzero(~found & (low + copy < high))
            at = start[left]
            own = _digests(texts, low[left] + copy, at, at + n[left] + window - 1)
            found[left] = [d == given[i] for d, i in zip(own, left, strict=True)]
        return want.filter(pa.array(~found)).cast(claims.select(_CHECK).schema)

    return run


def _kept(window: int):
    def run(key: Key, group: pa.Table, spans: pa.Table) -> pa.Table:
        ids, texts = _rows(group)
        spans = spans.sort_by("doc_row")
        rows, at = spans["doc_row"].to_numpy(), spans["at"].to_numpy()
        length = spans["n"].to_numpy() + window - 1
        cuts = np.searchsorted(rows, np.arange(len(ids) + 1))
        n_words, n_removed, kept = [], [], []
        for row, text in enumerate(texts.to_pylist()):
            words = (text or "").encode().split()
            own = slice(cuts[row], cuts[row + 1])
            n_words.append(len(words))
            if own.start == own.stop:
                n_removed.append(0)
            else:
                gone = covered(at[own], length[own], len(words))
                n_removed.append(int(gone.sum()))
                words = [w for w, removed in zip(words, gone, strict=True) if not removed]
            kept.append(b" ".join(words).decode())
        return pa.table(
            {
                "doc_id": pa.array(ids, mask=ids == NO_ID),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_text": pa.array(kept, pa.string()),
            }
        )

    return run


def _dealt(df: DataFrame, doc_id: str, text: str, part_bytes: int) -> tuple[DataFrame, int]:
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    parts = text_parts(docs, part_bytes=part_bytes)
    return docs.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")), parts


def _repeated_spans(docs: DataFrame, window: int, ranges: int) -> DataFrame:
    edges = docs.groupBy("part").applyInArrow(_edges(window, ranges), _BLOCK)
    answers = edges.groupBy("range").applyInArrow(_sources, _BLOCK)
    claimed = docs.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_spans(window, ranges), _SPAN)
    claimed = claimed.repartition("part")  # read twice below, made once
    claims = claimed.select(_CHECK).distinct()
    check = ", ".join(f"{name} {kind}" for name, kind in claims.dtypes)
    unlike = docs.groupBy("part").cogroup(claims.groupBy("src_part")).applyInArrow(_unlike(window), check)
    return claimed.join(unlike, _CHECK, "left_anti")


def _ranges(parts: int, part_bytes: int) -> int:
    return max(1, parts * part_bytes // RANGE_BYTES)


def repeated_spans(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The verified repeated paths: `n` edges from word `at` of a document, equal to those from `src_at` of `src_id`."""
    docs, parts = _dealt(df, doc_id, text, part_bytes)
    return _repeated_spans(docs, window, _ranges(parts, part_bytes))


def remove_repeats(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 13, part_bytes: int = PART_BYTES
) -> DataFrame:
    """One row per document: `doc_id, n_words, n_removed, kept_text`, without the words of repeated windows."""
    docs, parts = _dealt(df, doc_id, text, part_bytes)
    spans = _repeated_spans(docs, window, _ranges(parts, part_bytes)).select("part", "doc_row", "at", "n")
    return docs.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(_kept(window), _KEPT)
