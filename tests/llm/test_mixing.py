import duckdb
import pyarrow as pa

from corpusloom.llm.mixing import MixOptions, expanded, mixed, sized, targets
from corpusloom.llm.oracles import LLM_ORACLES
from tests.llm.conftest import EDGES, words

MANY = [(k, words(k * 37 % 91), f"s{k % 11 if k % 3 else 0}") for k in range(400)]
ODD = [(*r, source) for r, source in zip(EDGES, [None, "a", "b", "é", "Z"] * 4, strict=False)] + [(1, "x y", None)] * 3


def spark_rows(docs, rows, **named):
    found = mixed(sized(docs(rows), "doc_id", "text", "source"), **named).collect()
    return sorted(map(tuple, found), key=repr)


def test_against_sql(docs):
    for rows in (MANY, ODD, MANY + ODD, [(1, None, None)]):
        table = pa.table(
            {
                "doc_id": pa.array([r[0] for r in rows], pa.int64()),
                "text": pa.array([r[1] for r in rows], pa.string()),
                "source": pa.array([r[2] for r in rows], pa.string()),
            }
        )
        con = duckdb.connect()
        con.register("documents", table)
        # SQL joins equal rows with one row of each, as the operator does.
        want = sorted(con.execute(LLM_ORACLES["op7_mixing"]).fetchall(), key=repr)
        assert spark_rows(docs, rows) == want


def test_ranges_do_not_change_the_sample(docs):
    assert spark_rows(docs, MANY, options=MixOptions(range_rows=7)) == spark_rows(docs, MANY)


def test_targets_fill_up(docs):
    sizes = docs([(1, words(10), "a"), (2, words(1000), "b"), (3, words(100), "c")])
    found = {r.source: r.target for r in targets(sized(sizes, "doc_id", "text", "source"), MixOptions()).collect()}
    assert found["a"] == 20 and found["c"] == 200 and abs(sum(found.values()) - 1.5 * 1110) < 1e-9


def test_taken_is_near_target_and_bounded(docs):
    source_of, by_source = {r[0]: r[2] for r in MANY}, {}
    for doc_id, size, _, target, taken in spark_rows(docs, MANY):
        assert taken in (0, size, 2 * size)
        goal, so_far = by_source.get(source_of[doc_id], (target, 0))
        by_source[source_of[doc_id]] = goal, so_far + taken
    assert all(abs(taken - target) <= 91 for target, taken in by_source.values())


def test_expanded_rows_are_the_words_taken(docs):
    df = docs(MANY)
    found = expanded(df)
    assert found.columns == df.columns
    words_taken = sum(len((r.text or "").split()) for r in found.collect())
    assert words_taken == sum(r[4] for r in spark_rows(docs, MANY))


def test_empty_table(docs):
    none = sized(docs(EDGES).limit(0), "doc_id", "text", "source")
    assert mixed(none).collect() == []
