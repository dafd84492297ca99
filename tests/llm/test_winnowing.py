import random

import pyarrow as pa
from pyspark.sql import functions as F

from corpusloom.llm import winnowing
from corpusloom.llm.blocks import LETTERS_AND_DIGITS, blocks
from corpusloom.llm.store import cut
from corpusloom.llm.winnowing import contamination, uncontaminated, winnowed
from tests.llm import brute
from tests.llm.conftest import EDGES, words


def checked(spark, docs, rows, items):
    import hashlib

    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = [
        (r.doc_id, r._n_words, r._n_hit, len(r._items), hashlib.sha256(",".join(r._items).encode()).hexdigest(), r._n_hit > 0)
        for r in contamination(docs(rows), benchmark).collect()
    ]
    assert sorted(got, key=repr) == sorted(brute.contamination(rows, items), key=repr)


def test_edges(spark, docs):
    items = [
        (1, words(12)), (2, None), (3, ""), (10, words(12, "Z").upper()), (20, "ONE"), (21, "one-two"), (22, "é 🙂"),
        (23, words(30)), (24, words(30)), (25, "the the the the the the the the the the"), (26, "the the the"),
    ]
    checked(spark, docs, EDGES, items)


def test_random_texts_of_few_words(spark, docs):
    """A tiny vocabulary gives many ties, repeats and overlaps."""
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choices(["a", "B", "c", "d1", "é"], k=n))
    items = [(k, text(rng.choice([4, 10, 11, 25]))) for k in range(25)]
    rows = [(k, text(rng.randint(0, 120)) + ". " + rng.choice(items)[1][: rng.randint(0, 40)]) for k in range(80)]
    checked(spark, docs, rows, items)


def test_words_common_to_all_items_and_documents_give_no_pairs(spark, docs, monkeypatch):
    """One run of five words in every item and document: rows grow with the documents, not with documents times items."""
    common = "one run of five words"
    items = [(k, f"{words(20, f'i{k}x')} {common} {words(20, f'j{k}x')}") for k in range(60)]
    rows = [(k, f"{words(15, f'd{k}x')} {common} {words(15, f'e{k}x')}") for k in range(200)]
    rows += [(900, items[3][1]), (901, common), (902, words(6, "i5x") + " " + common)]
    made = []
    monkeypatch.setattr(winnowing, "cut", lambda df, name: made.append((name, cut(df, name))) or made[-1][1])
    checked(spark, docs, rows, items)
    sizes = {name: df.count() for name, df in made}
    assert sizes["places"] <= len(rows) and sizes["hits"] == 36 and sizes["found"] == 1


def test_earlier_columns_of_helper_names_stay(spark, docs):
    benchmark = spark.createDataFrame([(1, words(12))], "item_id bigint, text string")
    df = docs([(1, words(12)), (2, words(9))])
    for name in ("_key", "hit_key", "hit_of", "_hits", "hit_ranges", "hit_items"):
        df = df.withColumn(name, F.lit(name))
    kept = uncontaminated(df, benchmark)
    assert kept.columns == df.columns and [r.hit_key for r in kept.collect()] == ["hit_key"]


def test_every_window_has_a_fingerprint():
    rng = random.Random(6)
    text = " ".join(f"w{rng.randint(0, 30)}" for _ in range(500))
    _, _, block = next(iter(blocks(pa.array([text]), LETTERS_AND_DIGITS)))
    _, start = winnowed(block, 10, 5)
    assert all(any(k <= s <= k + 5 for s in start) for k in range(491))


def test_filter_keeps_columns_and_clean_rows(spark, docs):
    benchmark = spark.createDataFrame([(1, words(12))], "item_id bigint, text string")
    df = docs([(1, words(12)), (2, words(9)), (3, None)])
    kept = uncontaminated(df, benchmark)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(docs(EDGES).limit(0), none).collect() == []
    assert all(r._n_hit == 0 for r in contamination(docs(EDGES), none).collect())
