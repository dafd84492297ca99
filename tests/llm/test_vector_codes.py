import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from corpusloom.llm.vector_codes import CodeOptions, Coder, compressed


def brute(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, vector, label), ids not None. Returns (vec_id, code, error, label_error, sha256 of the codebooks)."""
    kept = [(i, [math.floor(Fraction(x) * 1024) for x in v], label) for i, v, label in rows if v is not None and all(
        x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0], r[1]))
    length = len(kept[0][1])
    width = length // parts
    same = [v for _, v, _ in kept if len(v) == length]
    books = [[v[p * width : (p + 1) * width] for v in same[:entries]] for p in range(parts)]

    def nearest(book, point):
        gaps = [sum((a - b) ** 2 for a, b in zip(point, entry)) for entry in book]
        return gaps.index(min(gaps)), min(gaps)

    for _ in range(rounds):
        for p in range(parts):
            points = [v[p * width : (p + 1) * width] for v in same]
            groups = {}
            for point in points:
                groups.setdefault(nearest(books[p], point)[0], []).append(point)
            books[p] = [
                [sum(column) // len(groups[e]) for column in zip(*groups[e])] if e in groups else entry
                for e, entry in enumerate(books[p])
            ]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    found, sums = [], {}
    for i, v, label in kept:
        code = error = None
        if len(v) == length:
            near = [nearest(books[p], v[p * width : (p + 1) * width]) for p in range(parts)]
            code, error = "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near)
        found.append((i, code, error, label))
        sums[label] = sums.get(label, 0) + (error or 0)
    return [(i, code, error, sums[label], digest) for i, code, error, label in found]


def ran(spark, rows, kind="float", **options):
    schema = f"vec_id bigint, embedding array<{kind}>, label int, code int, same_label string"
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], schema).repartition(4)
    found = compressed(df, CodeOptions(**options))
    assert "same_label" in found.columns
    return sorted(map(tuple, found.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def vectors(n, length, seed, spread=0.3):
    return (np.random.default_rng(seed).normal(0, spread, (n, length)).astype(np.float32)).tolist()


def test_against_brute_force_with_copies_nulls_and_ties(spark):
    rows = [(k, v, k % 3 or None) for k, v in enumerate(vectors(150, 16, 1))]
    rows += [(200 + k, rows[7][1], 2) for k in range(120)]
    rows += [(200, rows[7][1], 2), (400, None, 1), (401, [None] * 16, 1), (402, [float("nan")] * 16, 1)]
    rows += [(403, [float("inf")] + [0.0] * 15, None), (404, [0.5] * 8, 9), (405, [], 1), (7, [0.0] * 16, 4)]
    assert ran(spark, rows) == sorted(brute(rows), key=repr)
    few = {"entries": 5, "rounds": 2}
    for width in (1, 64, 4096):
        assert ran(spark, rows, cell_width=width, **few) == sorted(brute(rows, **few), key=repr)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [float("inf")] * 4, None), (2, [None], 2)]])
def test_no_usable_vector(spark, rows):
    assert ran(spark, rows) == []


def test_few_vectors_and_equal_entries(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0], None), (2, [1.0, 2.0, 3.0, 4.0], None), (3, [-1.0, 0.0, 0.0, -0.001], 1)]
    assert ran(spark, rows) == sorted(brute(rows), key=repr)


def test_components_outside_the_safe_range(spark):
    rows = [(k, v, k % 2) for k, v in enumerate(vectors(40, 8, 3))]
    rows += [(50, [2.0e6, -3.0e5, 0.0, 1.5, 0.0, 0.0, 7.0e4, 1.0], 5), (51, [-70000.5] * 8, 5)]
    want = brute(rows, entries=6, rounds=2)
    assert ran(spark, rows, "double", entries=6, rounds=2) == sorted(want, key=repr)
    # Squared distances beyond a long: the code stays, error and the sum of its label are NULL.
    huge = [*rows, (60, [3.0e30] * 4 + [1e300] * 4, 8)]
    found = ran(spark, huge, "double", entries=6, rounds=0)
    assert [r[2:4] for r in found if r[0] == 60] == [(None, None)] and all(r[1] for r in found)
    assert ran(spark, huge, "double", entries=6, rounds=2) == sorted(brute(huge, entries=6, rounds=2), key=repr)


def test_null_ids_come_last(spark):
    found = ran(spark, [(None, [5.0] * 4, 1), (3, [1.0] * 4, 1), (4, [5.1] * 4, 1)], entries=1, rounds=0)
    assert {r[0]: r[1] for r in found} == {None: "00000000", 3: "00000000", 4: "00000000"}
    assert {r[0]: r[2] for r in found}[3] == 0


def test_length_that_parts_do_not_divide(spark):
    with pytest.raises(ValueError, match="do not divide"):
        ran(spark, [(1, [1.0] * 6, 1)])


def test_memo_keeps_only_entries_that_may_be_nearest():
    draw = np.random.default_rng(5)
    entries = draw.integers(-300, 300, (256, 4))
    points = draw.integers(-300, 300, (5000, 4))
    coder = Coder(entries, 64)
    index, error = coder.nearest(points)
    gaps = ((points[:, None, :] - entries) ** 2).sum(2)
    assert (index == gaps.argmin(1)).all() and (error == gaps.min(1)).all()
    assert coder.evaluated < 0.2 * gaps.size
    assert len(coder.memo) <= 10**4
    before = len(coder.memo)
    assert (coder.nearest(points)[0] == index).all() and len(coder.memo) == before and coder.met >= before
