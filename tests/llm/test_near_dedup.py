import math
import random

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import near_dedup
from corpusloom.llm.components import components
from corpusloom.llm.near_dedup import (
    BITS,
    NearOptions,
    _compared,
    _confirmed_by_differences,
    _entries,
    _meeting,
    _recentred,
    near_duplicates,
    one_of_each,
)
from tests.llm import brute
from tests.llm.conftest import EDGES, words


def found(df, **named):
    return sorted(map(tuple, near_duplicates(df, **named).collect()), key=repr)


def near_copies(rng, base, n, changes):
    for _ in range(n):
        copy = list(base)
        for _ in range(changes):
            copy[rng.randrange(len(copy))] = f"new{rng.random()}"
        yield " ".join(copy)


@pytest.mark.parametrize("seed, with_base", [(1, True), (2, False)])
def test_groups_of_near_copies(docs, seed, with_base):
    """Copies that are near their base but not always near each other: links beyond the centre count."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(150)]
    texts = [" ".join(base)] * with_base
    texts += [t for k in (1, 2, 3) for t in near_copies(rng, base, 25, k)]
    texts += [" ".join(rng.choices(base, k=60)) for _ in range(20)]
    rows = list(enumerate(rng.sample(texts, len(texts)), 1000))
    assert found(docs(rows)) == sorted(brute.near_duplicates(rows), key=repr)


def test_edges(docs):
    rows = [r for r in EDGES if r[0] is not None]
    want = {r[0]: r for r in brute.near_duplicates(rows)}
    got = found(docs(EDGES))
    assert [r for r in got if r[0] is None] == [(None, 0, None, True), (None, 26, None, True)]
    assert [r for r in got if r[0] is not None] == sorted([want[i] for i, _ in rows], key=repr)


def test_rows_of_one_id_are_one_document(docs):
    got = found(docs([(5, words(30)), (5, words(30, "q")), (3, words(30, "q"))]))
    assert {r[2] for r in got} == {3}


def test_one_of_each_keeps_columns(docs):
    df = docs([(1, words(30)), (2, words(30)), (3, words(30, "q"))])
    kept = one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_empty_table(docs):
    assert near_duplicates(docs(EDGES).limit(0)).collect() == []


def test_confirmation_is_exact_at_the_threshold():
    a = words(104)  # 100 shingles
    for cut_words, linked in ((15, True), (16, False)):
        b = " ".join(a.split()[cut_words:])
        assert _compared(pa.array([a]), pa.array([b]), NearOptions())[0].tolist() == [linked]


def stars_of(texts, centre, options):
    linked, apart, n_own, n_centre = _compared(pa.array(texts), pa.array([centre] * len(texts)), options)
    lists = [[part.view(np.int64).tolist() for part in np.split(found, np.cumsum(n)[:-1])] for found, n in apart]
    return [
        (0, k + 1, bool(linked[k]), lists[0][k], lists[1][k], int(n_own[k]), int(n_centre[k])) for k in range(len(texts))
    ]


STARS = "centre bigint, rep bigint, linked boolean, extra array<bigint>, lack array<bigint>, n_own bigint, n_centre bigint"


def test_prefixes_of_linked_pairs_meet(spark):
    """Whatever the centre, two linked texts, one without a link to it, are among the pairs; differences alone confirm them."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(120)]
    options, texts = NearOptions(), []
    for _ in range(60):
        x = list(base)
        for _ in range(rng.randint(1, 8)):
            k = rng.randrange(len(x))
            x[k : k + rng.randint(0, 3)] = [f"n{rng.random()}"] * rng.randint(0, 2)
        y = list(x)
        for _ in range(rng.randint(0, 2)):
            del y[rng.randrange(len(y))]
        texts += [" ".join(x), " ".join(y)]
    rows = stars_of(texts, " ".join(base), options)
    stars = spark.createDataFrame(rows, STARS)
    pairs = _meeting(_entries(stars, options), options)
    met = {(r.b, r.a) for r in pairs.collect()}
    confirmed = {(r.b, r.a) for r in _confirmed_by_differences(pairs, stars, options).collect()}
    checked = 0
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            linked = bool(_compared(pa.array([texts[i]]), pa.array([texts[j]]), options)[0][0])
            if not (rows[i][2] and rows[j][2]) and linked:
                checked += 1
                assert (i + 1, j + 1) in met
            if (i + 1, j + 1) in met:
                assert ((i + 1, j + 1) in confirmed) == linked
    assert checked > 20


def test_new_centres_from_known_differences(spark):
    options, base = NearOptions(), words(100)
    texts = [base.replace("w7 ", "x "), words(60) + " " + words(40, "q"), words(100, "z"), words(20)]
    stars = spark.createDataFrame(stars_of(texts, base, options), STARS)
    pairs = spark.createDataFrame([(0, a, b) for a in (1, 2, 3, 4) for b in (1, 2, 3, 4) if a != b], "centre bigint, a bigint, b bigint")
    for r in _recentred(pairs, stars, options).collect():
        want = stars_of([texts[r.rep - 1]], texts[r.centre - 1], options)[0]
        assert (r.linked, sorted(r.extra), sorted(r.lack), r.n_own, r.n_centre) == (want[2], sorted(want[3]), sorted(want[4]), *want[5:])


def template_pages(n, own=40, blocks=5, seed=3):
    """Pages of common words, one of some blocks and words of their own."""
    rng = random.Random(seed)
    common = [f"c{k}" for k in range(300)]
    parts = [[f"t{b}_{k}" for k in range(60)] for b in range(blocks)]
    for k in range(n):
        yield k, " ".join(common + rng.choice(parts) + [f"o{k}_{j}" for j in range(own)])


def pairs_made(spark, docs, rows, options):
    """Rows of the largest step between stars and links."""
    made = []
    before = near_dedup._meeting
    near_dedup._meeting = lambda entries, options: made.append(before(entries, options)) or made[-1]
    try:
        result = found(docs(rows), options=options)
        return result, sum(df.count() for df in made)
    finally:
        near_dedup._meeting = before


@pytest.mark.parametrize("percent, own", [(85, 40), (80, 12)])
def test_pages_of_one_template_do_not_meet_in_pairs(spark, docs, percent, own):
    options = NearOptions(percent=percent)
    numbers = {}
    for n in (150, 600):
        rows = list(template_pages(n, own))
        got, numbers[n] = pairs_made(spark, docs, rows, options)
        if n == 150:
            assert got == sorted(brute.near_duplicates(rows, percent=percent), key=repr)
    assert numbers[600] <= 5 * max(numbers[150], 200)


@pytest.mark.parametrize("hot, rounds", [(2, 12), (2, 1)])
def test_further_rounds_lose_no_link(docs, monkeypatch, hot, rounds):
    """Groups above the bound go through rounds of stars, with the same components as by pairs."""
    monkeypatch.setattr(near_dedup._with_rest, "__defaults__", (hot, rounds))
    rng = random.Random(4)
    base = [f"b{k}" for k in range(150)]
    texts = [t for k in (1, 2, 3, 4) for t in near_copies(rng, base, 20, k)]
    rows = list(enumerate(rng.sample(texts, len(texts)), 1000))
    assert found(docs(rows)) == sorted(brute.near_duplicates(rows), key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_estimate_leaves_out_fewer_than_the_bands(percent):
    """Binomial tail of equal entries under the least estimate, for a pair at the threshold."""
    options = NearOptions(percent=percent)
    share, chance, n = percent / 100, 2.0**-BITS, options.hashes
    equal = share + (1 - share) * chance
    dropped = [k for k in range(n + 1) if (k / n - chance) / (1 - chance) < options.least_estimate]
    tail = sum(math.comb(n, k) * equal**k * (1 - equal) ** (n - k) for k in dropped)
    assert tail < (1 - share**options.rows) ** options.bands / 100


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in rows} == {k: 0 for k in range(1, 41)} | {k: 100 for k in range(101, 150)}


def test_estimate_follows_similarity(spark):
    from pyspark.sql import functions as F

    from corpusloom.llm.blocks import blocks
    from corpusloom.llm.near_dedup import _signatures, estimate

    options, texts = NearOptions(), [words(1000), words(950), words(30, "q")]
    _, _, block = next(iter(blocks(pa.array(texts))))
    packed = _signatures(block, options)[3].view(np.int64).tolist()
    df = spark.createDataFrame([(packed[0], packed[k]) for k in range(3)], "a array<bigint>, b array<bigint>")
    same, near, far = (r[0] for r in df.select(estimate(F.col("a"), F.col("b"), options.hashes)).collect())
    assert same == 1 and abs(near - 0.95) < 0.12 and abs(far) < 0.12
