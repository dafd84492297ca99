import random

import pyarrow as pa
import pytest
import sentencepiece

from corpusloom.llm.token_counts import TokenOptions, counter, text_counts, token_counts
from tests.llm.conftest import EDGES

MODEL = TokenOptions().model
TRICKY = [
    "a " * 50, " ", "  ", "a", " a", "a ", "a  b   c    ", "▁a ▁ b▁", "\n a \t b", "x" * 3000, "日本語 テキスト" * 50,
    "<s> </s> <unk> <0x0A> a", " \n ", "é è" * 20, "      \n      x", "🙂 🙂🙂 " * 9, "a  b", "\x00 \x1c a",
]


@pytest.fixture(scope="module")
def exact():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda text: len(model.encode(text or ""))


@pytest.mark.parametrize("chunk, overlap", [(32_768, 256), (40, 4), (16, 8)])
def test_counts_match_the_library(docs, exact, chunk, overlap):
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choices(" ab▁é\n.日🙂 <s>", k=rng.randint(1, 300))) for _ in range(100)]
    rows = [*enumerate(texts, 100), *EDGES]
    options = TokenOptions(chunk_chars=chunk, overlap_chars=overlap)
    got = token_counts(docs(rows), options=options).select("doc_id", "text", "_n_tokens", "_n_bytes", "_over_limit")
    got = sorted(map(tuple, got.collect()), key=repr)
    want = [(i, t, n := exact(t), len((t or "").encode()), n > 4096) for i, t in rows]
    assert got == sorted(want, key=repr)


def test_units_at_block_ends(exact, monkeypatch):
    monkeypatch.setattr("corpusloom.llm.blocks.BLOCK_BYTES", 8)
    assert text_counts(pa.array(TRICKY), MODEL).tolist() == [exact(t) for t in TRICKY]


def test_stable_places():
    found = counter(MODEL)
    assert found.cuts_at_spaces and found.stable("a", " ") and not found.stable("t", "h")


def test_empty_table(docs):
    assert token_counts(docs(EDGES).limit(0)).collect() == []
