"""DuckDB SQL for op13_merkle_manifest: the tree unrolled level by level, with the proof of every leaf."""

from __future__ import annotations

# 16 ** 6 rows of one group, and as many groups, are a tree of six levels; a lone node stays as it is on all further levels.
LEVELS = 6


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, group: str) -> str:
    """Levels {name}0 to {name}LEVELS with what lies left and right of every node in its run, and the climb over them."""
    steps = []
    for k in range(LEVELS):
        steps.append(f"""
  {name}{k}s AS (
    SELECT *, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
      coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
    FROM {name}{k} WINDOW run AS (PARTITION BY {group}, pos // 16 ORDER BY pos)
  ),
  {name}{k + 1} AS (
    SELECT {group}, pos // 16 AS pos, (first(size) + 15) // 16 AS size,
      CASE WHEN first(size) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE first(h) END AS h
    FROM {name}{k} GROUP BY {group}, pos // 16
  ),""")
    return "".join(steps)


def _climb(rows: str, name: str, tree: str, group: str, pos: str) -> str:
    """Fold the column `f` of `rows` up the tree and append the siblings to `proof`; ends in {name}LEVELS."""
    steps = [f"\n  {name}0 AS (SELECT *, {pos} AS spot FROM {rows}),"]
    for k in range(LEVELS):
        steps.append(f"""
  {name}{k + 1} AS (
    SELECT c.* REPLACE (c.spot // 16 AS spot, CASE WHEN n.size > 1 THEN sha256(n.l || c.f || n.r) ELSE c.f END AS f,
      CASE WHEN n.size > 1 THEN c.proof || n.l || n.r ELSE c.proof END AS proof)
    FROM {name}{k} c JOIN {tree}{k}s n ON c.{group} IS NOT DISTINCT FROM n.{group} AND c.spot = n.pos
  ),""")
    return "".join(steps)


# crc32 bit by bit: 0xEDB88320 is the polynomial, 0xFFFFFFFF the first and the last mask.
CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, bit: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""

OP13 = f"""
WITH given AS (
    SELECT doc_id, source, lang, n_chars, text, 0 AS one,
      CASE WHEN doc_id IS NOT NULL AND {CRC32} % 5 = 0
        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claim
    FROM documents
  ),
  leaves AS (SELECT doc_id, source, one, {_leaf("text")} AS h, {_leaf("claim")} AS f, '' AS proof FROM given),
  a0 AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
      count(*) OVER (PARTITION BY source) AS size
    FROM leaves
  ),{_tree("a", "source")}
  t0 AS (
    SELECT 0 AS one, source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
    FROM a{LEVELS}
  ),{_tree("t", "one")}{_climb("(SELECT *, h AS leaf FROM a0)", "c", "a", "source", "pos")}
  subbed AS (
    SELECT c.*, t.h AS subroot, t.pos AS place FROM c{LEVELS} c JOIN t0 t ON c.source IS NOT DISTINCT FROM t.source
  ),{_climb("(SELECT * EXCLUDE (spot) FROM subbed)", "d", "t", "one", "place")}
  done AS (SELECT d.*, t.h AS root FROM d{LEVELS} d, t{LEVELS} t)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified FROM done
"""
