import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm.blocks import text_bytes
from corpusloom.llm.packing import PackOptions, best_fit, encoder, packed, positions
from tests.llm.conftest import EDGES


@pytest.fixture(scope="module")
def coder():
    return encoder(PackOptions().vocabulary, PackOptions().pattern)


@pytest.mark.parametrize("row_tokens", [4096, 16])
def test_round_trip(docs, coder, row_tokens):
    """Every document comes back whole, as often as it was given."""
    rows = packed(docs(EDGES), options=PackOptions(row_tokens=row_tokens), part_bytes=3_000).collect()
    pieces = []
    for r in rows:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == row_tokens and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        assert (ids[r.n_tokens :] == 50256).all()
        for doc, start, lo, hi in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            pieces.append((doc, start, ids[lo:hi].tolist()))
    want = []
    for doc, text in EDGES:
        ids = coder.whole(text or "") + [50256]
        want += [(doc, k, ids[k : k + row_tokens]) for k in range(0, len(ids), row_tokens)]
    assert sorted(pieces, key=repr) == sorted(want, key=repr)


def test_best_fit_decreasing_against_a_plain_search():
    rng = random.Random(5)
    for _ in range(50):
        capacity = rng.randint(1, 70)
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        room, rows = [], []
        for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
            fits = [r for r in range(len(room)) if room[r] >= lengths[piece]]
            if fits:
                row = min(fits, key=lambda r: room[r])
            else:
                row = len(room)
                room.append(capacity)
                rows.append([])
            room[row] -= lengths[piece]
            rows[row].append(piece)
        got = best_fit(lengths, capacity)
        assert sorted(p for row in got for p in row) == list(range(len(lengths)))
        left = sorted(capacity - sum(lengths[p] for p in row) for row in got)
        assert left == sorted(room)


def test_units_match_whole_texts(coder):
    rng = random.Random(1)
    texts = ["".join(rng.choices(" ab'é\n.日🙂   \t  s't12", k=rng.randint(0, 150))) for _ in range(300)]
    for k in range(0, len(texts), 7):
        ids, at = coder.encode(*text_bytes(pa.array(texts[k : k + 7])))
        for row, text in enumerate(texts[k : k + 7]):
            assert ids[at[row] : at[row + 1]].tolist() == coder.whole(text)


def test_positions_restart():
    assert positions([0, 3, 5], 8).tolist() == [0, 1, 2, 0, 1, 0, 1, 2]


def test_empty_table(docs):
    assert packed(docs(EDGES).limit(0)).collect() == []
