"""Token ids packed into fixed rows by best-fit decreasing.

Documents are dealt into parts of a few MB of text by a hash of id and text, so a part is a bounded group whatever
the number of documents or copies. Inside a part every document is tokenised (byte-level BPE of a public
vocabulary) and ends with the end id. A document longer than a row is split into full rows and a rest, without loss. The pieces
are placed from the longest to the shortest, each into the fullest row that still has room; a segment tree over
capacities finds that row in logarithmic time. Each row leaves one task as little-endian ids padded to the full
length, so the rows of a table are a matrix of ids. Each part leaves at most about one ill-filled row more than packing all together.

Besides the ids a row has its cumulative segment lengths (`cu_seqlens`, from 0), the places where positions restart
(`position_resets`), and for each segment the document id and the token offset inside the document.

Equal words are tokenised once per worker: the vocabulary's pattern never lets a token span the place before a run of
blanks that follows a non-blank, so the units between such places are independent. Texts with blanks beyond ASCII
are tokenised whole.

Defined cases: NULL and empty texts are the end id alone. Documents with a NULL id are packed with a NULL in
`doc_ids`. Repeated rows are packed as often as they occur. Other columns are not read.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.blocks import Words, row_ranges, text_bytes
from corpusloom.llm.store import text_parts

PART_BYTES = 4 << 20
_CACHED_UNITS = 200_000
_WIDE_BLANK = re.compile("[\x85\xa0  -     　]")
_BLANK = np.array([b == 0x20 or 0x09 <= b <= 0x0D for b in range(256)])

Key = tuple[pa.Scalar, ...]
PACKED = (
    "part int, row_no int, ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_starts array<bigint>"
)


@dataclass(frozen=True)
class PackOptions:
    vocabulary: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    row_tokens: int = 4096
    end_id: int = 50256
    pad_id: int = 50256
    dtype: str = "<u2"


class Encoder:
    def __init__(self, vocabulary: str, pattern: str):
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.by_blanks = pattern == public_tokenizers.PATTERN
        self.units: dict[bytes, list[int]] = {}

    def whole(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of texts, and the n + 1 row offsets into them."""
        raw = data.tobytes()
        if not self.by_blanks or not raw.isascii() and _WIDE_BLANK.search(raw.decode()):
            rows = [self.whole(raw[s:e].decode()) for s, e in zip(at, at[1:], strict=False)]
            return np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64), _offsets([len(r) for r in rows])
        blank = _BLANK[data]
        opens = blank & ~np.concatenate([[True], blank[:-1]]) if len(data) else blank
        opens[at[:-1][np.diff(at) > 0]] = True
        start = np.flatnonzero(opens)
        end = np.append(start[1:], len(data)) if len(start) else start
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        _, index, which = np.unique(Words(data, at, start, end).hashes, return_index=True, return_inverse=True)
        contents = [raw[s:e] for s, e in zip(start[index].tolist(), end[index].tolist(), strict=True)]
        if len(self.units) > _CACHED_UNITS:
            self.units.clear()
        known = self.units
        for content in contents:
            if content not in known:
                known[content] = self.whole(content.decode())
        found = [known[c] for c in contents]
        size = np.array([len(f) for f in found])
        flat = np.concatenate(found).astype(np.int64)
        n = size[which]
        before = np.cumsum(n) - n
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - before, n) + np.arange(n.sum())]
        row = np.searchsorted(at, start, side="right") - 1
        return ids, _offsets(np.bincount(row, n, minlength=len(at) - 1).astype(np.int64))


def _offsets(lengths) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))]).astype(np.int64)


@cache
def encoder(vocabulary: str, pattern: str) -> Encoder:
    return Encoder(vocabulary, pattern)


class Capacities:
    """Rows by room left: a segment tree over the capacities 0 to `most` that counts the rows under each node."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and return (row, room) of a row with the smallest room of at least `least`."""
        node = self.leaves + least
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.rows[room].pop(), room


def best_fit(lengths, capacity: int) -> list[list[int]]:
    """Rows of piece numbers: longest piece first, each into the fullest row with room for it."""
    free, rows = Capacities(capacity), []
    for piece in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        length = int(lengths[piece])
        found = free.take(length)
        if found is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row, room = found
        rows[row].append(piece)
        if room > length:
            free.add(row, room - length)
    return rows


def _pack(options: PackOptions):
    def run(key: Key, group: pa.Table) -> pa.Table:
        coder = encoder(options.vocabulary, options.pattern)
        group = group.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        data, at = text_bytes(group["text"])
        docs = group["doc_id"].to_pylist()
        ids, lengths = [], []
        for lo, hi in row_ranges(at):
            found, offsets = coder.encode(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            ids.append(np.insert(found, offsets[1:], options.end_id))
            lengths.append(np.diff(offsets) + 1)
        ids, starts = np.concatenate(ids), _offsets(np.concatenate(lengths))
        pieces = [
            (doc, offset, min(options.row_tokens, n - offset))
            for doc, n in enumerate(np.diff(starts).tolist())
            for offset in range(0, n, options.row_tokens)
        ]
        rows = best_fit([p[2] for p in pieces], options.row_tokens)
        matrix = np.full((len(rows), options.row_tokens), options.pad_id, options.dtype)
        columns = {name: [] for name in ("n_tokens", "cu_seqlens", "position_resets", "doc_ids", "doc_starts")}
        for number, row in enumerate(rows):
            ends = _offsets([pieces[p][2] for p in row])
            for p, lo, hi in zip(row, ends, ends[1:], strict=False):
                begin = starts[pieces[p][0]] + pieces[p][1]
                matrix[number, lo:hi] = ids[begin : begin + hi - lo]
            columns["n_tokens"].append(int(ends[-1]))
            columns["cu_seqlens"].append(ends)
            columns["position_resets"].append(ends[:-1])
            columns["doc_ids"].append([docs[pieces[p][0]] for p in row])
            columns["doc_starts"].append([pieces[p][1] for p in row])
        kinds = (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table(
            {
                "part": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                "row_no": pa.array(range(len(rows)), pa.int32()),
                "ids": pa.array([r.tobytes() for r in matrix], pa.binary()),
                **{name: pa.array(v, kind) for (name, v), kind in zip(columns.items(), kinds, strict=True)},
            }
        )

    return run


def packed(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    options: PackOptions = PackOptions(),
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Packed rows: `part, row_no, ids` and the segments of each row."""
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    parts = text_parts(docs, part_bytes=part_bytes)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int")
    return docs.withColumn("part", part).groupBy("part").applyInArrow(_pack(options), PACKED)


def positions(cu_seqlens, row_tokens: int) -> np.ndarray:
    """Position ids of a row: from 0 in every segment, and in the padding."""
    resets = np.append(cu_seqlens, row_tokens)
    return np.concatenate([np.arange(n) for n in np.diff(resets)])
