import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""

    def make(rows):
        rows = [(*r, "s0") if len(r) == 2 else r for r in rows]
        schema = "doc_id bigint, text string, source string, key string, part string, n bigint, item string, rep string"
        return spark.createDataFrame([(*r, "k", "p", 7, None, "r") for r in rows], schema).repartition(3)

    return make


def words(n, prefix="w"):
    return " ".join(f"{prefix}{k}" for k in range(n))


EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two"), (6, words(30)), (7, words(30)), (7, words(30)),
    (8, words(30) + "\n" + words(5, "x")), (None, words(30)), (None, None), (9, "é 🙂  日本 語"), (10, words(12, "z")),
    (11, words(20_000, "long")), (12, "x" * 200_000), (13, words(20_000, "long") + " end"),
    (14, "the the the the the the the the the the the the the the"),
]
