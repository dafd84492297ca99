import random

import numpy as np

from corpusloom.llm.ordinal import OrdinalOptions, fit, graded, train
from tests.llm.conftest import EDGES

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        words = rng.choices([f"w{j}" for j in range(3000)], k=rng.randint(20, 200))
        toxic, poor = k % 5 == 0, k % 5 == 1
        if toxic:
            words += ["vile", rng.choice(["Nasty", "mean!"])]
        if poor:
            words = [w + " |||" for w in words]
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(not poor), int(toxic)))
    return rows, labels


def test_held_out_grades(spark, docs):
    rows, labels = corpus(600, 1)
    model = train(docs(rows), spark.createDataFrame(labels[:400], LABELS))
    assert (np.diff(model.thresholds) > 0).all()
    held_out, grades = rows[400:], {k: 0 if t else 2 if q else 1 for k, q, t in labels}
    found = graded(docs(held_out), model).collect()
    right = [r._kept == (grades[r.doc_id] == 2) for r in found]
    assert np.mean(right) > 0.97
    assert all(r._p_ge_1 >= r._p_ge_2 and abs(r._expected_grade - r._p_ge_1 - r._p_ge_2) < 1e-9 for r in found)


def test_reruns_agree(spark, docs):
    rows, labels = corpus(100, 2)
    one, two = (train(docs(rows), spark.createDataFrame(labels, LABELS)) for _ in range(2))
    assert (one.weights == two.weights).all() and (one.thresholds == two.thresholds).all()


def test_edges_and_missing_labels(spark, docs):
    none = train(docs(EDGES), spark.createDataFrame([], LABELS))
    assert not none.weights.any() and none.thresholds.tolist() == [-1, 1]
    labels = [(6, 1, 0), (7, None, 0), (None, 1, 0), (8, 1, 1), (8, 1, 0), (999, 0, 0)]
    model = train(docs(EDGES), spark.createDataFrame(labels, LABELS))
    assert graded(docs(EDGES), model).count() == len(EDGES)
    assert graded(docs(EDGES).limit(0), model).collect() == []


def test_slopes_of_the_loss():
    """One step on one text moves its score towards its grade."""
    options = OrdinalOptions(epochs=1, batch=1, least_docs=1, lasso=0.0, bits=4)
    for grade, sign in ((0, -1), (2, 1)):
        model = fit(np.array([3]), np.array([0]), np.array([grade]), options)
        assert np.sign(model.weights[3]) == sign
