import hashlib
import random

import pytest

from corpusloom.llm.substring import _pack, _unpack, remove_repeats, repeated_spans
from tests.llm import brute
from tests.llm.conftest import EDGES, words


def removed(df, **named):
    rows = remove_repeats(df, **named).collect()
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows), key=repr
    )


@pytest.mark.parametrize("part_bytes", [4 << 20, 500])
def test_edges_match_brute_force(docs, part_bytes, monkeypatch):
    monkeypatch.setattr("corpusloom.llm.substring.RANGE_BYTES", 2_000)
    want = sorted(brute.remove_repeats(EDGES), key=repr)
    assert removed(docs(EDGES), part_bytes=part_bytes) == want


def test_random_overlaps(docs):
    rng = random.Random(3)
    pool = [f"t{k}" for k in range(400)]
    passages = [" ".join(rng.choices(pool, k=rng.randint(5, 40))) for _ in range(12)]
    rows = []
    for i in range(150):
        own = [" ".join(rng.choices(pool, k=rng.randint(0, 20))) for _ in range(3)]
        rows.append((rng.randint(0, 10**12), " ".join(x for k in own for x in (k, rng.choice(passages)))))
    assert removed(docs(rows), part_bytes=2_000) == sorted(brute.remove_repeats(rows), key=repr)


def test_spans_are_compacted(docs):
    text = words(50)
    found = repeated_spans(docs([(1, text), (2, "a b " + text), (3, text + " c")])).collect()
    assert sorted((r.at, r.n, r.src_id, r.src_at) for r in found) == [(0, 38, 1, 0), (2, 38, 1, 0)]


def test_empty_table(docs, spark):
    assert remove_repeats(docs(EDGES).limit(0)).collect() == []


def test_planes_round_trip():
    import numpy as np

    a, b = np.array([0, 2**63, 7], np.uint64), np.array([-1, 5, 0], np.int64)
    for got, want in zip(_unpack(_pack(a, b), 3, np.uint64, np.int64), (a, b), strict=True):
        assert (got == want).all()
