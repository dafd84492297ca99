import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.merkle import FANOUT, build, checked_documents, leaves_of, verify

from .conftest import EDGES


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)])


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """Root of the nodes, and for each of them a list of (left, right) siblings on the way up."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for path, k in zip(paths, at):
            run = k // FANOUT * FANOUT
            path.append((level[run:k], level[k + 1 : run + FANOUT]))
        level = [H(*level[k : k + FANOUT]) for k in range(0, len(level), FANOUT)]
        at = [k // FANOUT for k in at]
    return level[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    trees = {}
    for source, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[source] = (members, *tree([leaf(r, r[4]) for r in members]))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, top = tree([trees[s][1] for s in order])
    found = []
    for source, above in zip(order, top):
        members, subroot, paths = trees[source]
        for row, path in zip(members, paths):
            tampered = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded, proof = leaf(row, lowered(row[4]) if tampered else row[4]), ""
            for left, right in path + above:
                folded, proof = H(*left, folded, *right), proof + "".join(left + right)
            found.append((row[0], leaf(row, row[4]), subroot, root, H(proof), folded, folded == root))
    return found


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, pos int, size int, digest string"


def ran(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(5)
    found = checked_documents(df).select("key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(7, "a", None, None, "Lone Leaf")],
        [(k, "a", "en", k, f"Text {k}") for k in range(17)],
        [(k, f"s{k}", "en", k, f"Text {k}") for k in range(40)],
        [(k, "hot" if k % 3 else None, "en", None, f"Text É {k}") for k in range(700)],
        [(5, "a", "en", 1, "Same")] * 300 + [(None, "b", None, 3, None)] * 20 + [(5, "a", "en", 1, "Other")],
        [(i, ["a", "", None, "é", "z"][n % 5], "en", n, t) for n, (i, t) in enumerate(EDGES)],
    ],
)
def test_against_brute_force(spark, rows):
    want = sorted(brute(rows), key=repr) if rows else []
    assert ran(spark, rows) == want


def test_changed_leaf_is_found_and_order_of_rows_is_free(spark):
    df = spark.createDataFrame([(k, "g", f"t{k}") for k in range(50)], "k int, g string, t string")
    forged = F.when(F.col("k") == 33, "forged").otherwise(F.col("t"))
    roots = set()
    for parts in (1, 7):
        found = verify(build(leaves_of(df.repartition(parts), "g", "k", ["k", "t"], {"t": forged}))).collect()
        assert [r.key for r in found if not r.verified] == [33]
        roots |= {r.root for r in found}
    assert len(roots) == 1


def test_row_limit_of_recursion_is_left_as_it_was(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    ran(spark, [(1, "a", "en", 1, "x"), (2, "a", "en", 1, "y")])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_node_rows_link_to_their_parents(spark):
    df = spark.createDataFrame([(k, f"g{k % 3}", f"t{k}") for k in range(900)], "k int, g string, t string")
    made = build(leaves_of(df, "g", "k", ["k", "t"]))
    nodes = {r.node_id: r for r in made.nodes.collect()}
    runs = made.runs.collect()
    assert sum(len(r.members) for r in runs) == 900 and max(len(r.members) for r in runs) == FANOUT
    for r in [*runs, *nodes.values()]:
        if r.parent_id:
            digest = hashlib.sha256(bytes(r.run).hex().encode()).digest()
            assert bytes(nodes[r.parent_id].run)[32 * r.slot : 32 * r.slot + 32] == digest
    assert [r.node_id for r in nodes.values() if r.parent_id is None] == ["top/1/0"]
