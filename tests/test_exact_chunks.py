"""Chunks under a real tokenizer's limit against a version that encodes every joined text anew."""

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import headings, sections
from corpusloom.operators.exact_chunks import BETWEEN_WORDS, Counter, ExactTokenizer, exact_chunks, recombine_exact
from corpusloom.options import ChunkOptions
from corpusloom.plans import documents, inputs

tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"


def byte_bpe():
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    return ExactTokenizer(lambda text: len(known.encode(text, add_special_tokens=False).ids), BETWEEN_WORDS)


def word_bpe():
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    known.encode_special_tokens = True
    return ExactTokenizer(lambda text: len(known.encode(text, add_special_tokens=False).ids), BETWEEN_WORDS)


def piece_bpe():
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    known = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return ExactTokenizer(lambda text: len(known.encode(text)), BETWEEN_WORDS, drops_blank=True)


def placeless():
    """A count that is far from adding up, without places: four characters a token, blanks once."""
    return ExactTokenizer(lambda text: -(-len(re.sub(r"\s+", " ", text)) // 4))


LOADS = [byte_bpe, word_bpe, piece_bpe, placeless]


def brute_groups(units, limit, count):
    """units: (text, separator, opens anyway). Every joined text is encoded as a whole."""
    groups = []
    for text, sep, opens in units:
        if groups and not opens and count(groups[-1] + sep + text) <= limit:
            groups[-1] += sep + text
        else:
            groups.append(text)
    return groups


def brute_halves(text, limit, count):
    if len(text) < 2 or count(text) <= limit:
        return [text]
    at = text.rfind(" ", 0, len(text) // 2) + 1 or len(text) // 2
    return brute_halves(text[:at], limit, count) + brute_halves(text[at:], limit, count)


def brute_parts(heading, title, blocks, sentences, options, count):
    limit = max(options.max_tokens - count(title) - options.heading_reserve, 1)
    while True:
        units = []
        for block, parts in zip(blocks, sentences):
            if count(block) <= limit:
                units.append((block, "\n\n", False))
            else:
                for k, s in enumerate(parts):
                    units += [(p, "\n", k == 0 or j > 0) for j, p in enumerate(brute_halves(s, limit, count))]
        bodies = brute_groups(units, limit, count)
        whole = [sections.part_text(heading, b, k, len(bodies)) for k, b in enumerate(bodies)]
        over = max(map(count, whole)) - options.max_tokens
        if over <= 0 or limit == 1:
            return whole
        limit = max(limit - over, 1)


@pytest.fixture(scope="module")
def guides(spark):
    rows = inputs.guides(spark, SF).select("doc_id", headings.split_generic(F.col("content")).alias("chunks"))
    rows = rows.repartition(8).cache()
    rows.count()
    yield rows
    rows.unpersist()


@pytest.mark.parametrize("load", LOADS)
def test_sections_of_all_documents(guides, load):
    options = ChunkOptions(max_tokens=400)
    count, heading = load().count, re.compile(r"^(#{1,6}[ \t]+\S|[^\s#][^\n]+\n[-=]{3,}[ \t]*(\n|\Z))")
    found = {r.doc_id: r.chunks for r in recombine_exact(guides, "chunks", load, options).collect()}
    for r in guides.collect():
        units = [(c, "\n\n", bool(heading.match(c))) for c in r.chunks]
        assert found[r.doc_id] == brute_groups(units, 400, count)


@pytest.mark.parametrize("load", LOADS)
def test_no_chunk_of_any_document_is_above_the_limit(spark, guides, load):
    options = ChunkOptions(max_tokens=230, heading_reserve=40)
    count = load().count
    rows = exact_chunks(guides.withColumn("section", F.lit("own")), "chunks", load, options)
    assert rows.columns == ["doc_id", "section", "section_no", "part_no", "text"]
    found = {(r.doc_id, r.section_no, r.part_no): r.text for r in rows.collect()}
    assert max(map(count, found.values())) <= 230
    # The same groups as by encoding everything anew, from the same sections, blocks and sentences.
    merged = recombine_exact(guides, "chunks", load, options).select(
        "doc_id", F.posexplode(sections.merge_orphans(F.col("chunks"), options)).alias("no", "chunk")
    )
    cut = merged.withColumn("h", sections.split_heading(F.col("chunk"))).withColumn("b", sections.heading_blocks(F.col("h")))
    want, split = {}, 0
    for r in cut.withColumn("s", F.transform("b", lambda b: sections.sentences_of(b))).collect():
        parts = [r.chunk]
        if r.b and count(r.chunk) > 230:
            parts = brute_parts(r.h.heading, r.h.title, r.b, r.s, options, count)
            split += 1
        want |= {(r.doc_id, r.no + 1, k + 1): text for k, text in enumerate(parts)}
    assert split > 300 and found == want


def test_seams_alone_are_encoded_again():
    text = "word and word again, then more of it. " * 40
    counter = Counter(byte_bpe())
    units = [(text, "\n\n", False)] * 50
    assert counter.marks(units, 10**9) == [True] + [False] * 49
    assert counter.encoded < 1.1 * 50 * len(text)


@pytest.mark.parametrize("load", LOADS)
def test_counts_of_joined_texts(load):
    texts = ["a b c", "", " ", "x", "Ünï cödé wörds hére", "one two\n\n", "\n\nthree four", "日本 語 a b", "it's a. b", "<|endoftext|> a b"]
    counter, tokenizer = Counter(load()), load()
    for a in texts:
        for b in texts:
            for sep in ("", "\n", "\n\n", " "):
                total, group = counter.grown(counter.opened(counter.unit(a))[1], sep, counter.unit(b))
                assert total == tokenizer.count(a + sep + b)
                again, _ = counter.grown(group, sep, counter.unit(a))
                assert again == tokenizer.count(a + sep + b + sep + a)


def test_edges(spark):
    rows = spark.createDataFrame(
        [(1, None), (2, []), (3, ["# Only a heading " + "x " * 400]), (4, ["w" * 3000])],
        "k int, chunks array<string>",
    )
    options = ChunkOptions(max_tokens=120, heading_reserve=20)
    found = exact_chunks(rows, "chunks", byte_bpe, options).collect()
    assert {r.k for r in found} == {3, 4} and [r.part_no for r in found if r.k == 3] == [1]
    longest = [r.text for r in found if r.k == 4]
    count = byte_bpe().count
    assert len(longest) > 3 and max(map(count, longest)) <= 120
    assert sum(t.count("w") for t in longest) == 3000


def test_documents_to_prompts_under_a_tokenizers_limit(spark):
    """All pages of known sites in chunks that the tokenizer counts at most so many tokens in, numbered without gaps."""
    docs = inputs.site_pages(spark, SF).withColumn("title", F.lit(""))
    cleaned = documents.cleaned_documents(docs).repartition(8).cache()
    options, count = ChunkOptions(max_tokens=250, heading_reserve=60), byte_bpe().count
    rows = documents.chunked_exact(cleaned, byte_bpe, options).collect()
    numbers, known = {}, set()
    for r in rows:
        numbers.setdefault(r.doc_id, []).append(r.chunk_no)
        if any(site in r.url for site in documents.SPLITTERS):
            known.add(r.doc_id)
            assert count(r.text) <= 250
    assert len(known) > 500 and all(sorted(n) == list(range(1, len(n) + 1)) for n in numbers.values())
    assert set(numbers) == {r.doc_id for r in cleaned.select("doc_id").collect()}
    cleaned.unpersist()
    made = documents.document_prompts(docs.limit(40), options, tokenizer=byte_bpe)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert made.columns == documents.document_prompts(docs.limit(40), options).columns and "hashpartitioning" not in plan
