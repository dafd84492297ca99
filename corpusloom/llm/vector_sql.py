"""DuckDB SQL for op12_vector_codes: every vector against every entry, round by round."""

from __future__ import annotations

ROUNDS = 4

# Parts are lists of whole numbers as doubles; their products and sums are exact as long as they are below 2 ** 53.
_GIVEN = """
WITH kept AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS id,
      list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  ),
  parts AS (
    SELECT id, p, list_slice(v, p * len(v) // 4 + 1, (p + 1) * len(v) // 4) AS part
    FROM kept, (SELECT unnest(range(4)) AS p)
  ),
  book0 AS (SELECT p, id - 1 AS entry, part FROM parts WHERE id <= 256),"""


def _near(r: int) -> str:
    return f"""
  near{r} AS (
    SELECT a.id, a.p, a.part, b.entry,
      list_inner_product(a.part, a.part) - 2 * list_inner_product(a.part, b.part) + list_inner_product(b.part, b.part) AS d
    FROM parts a JOIN book{r} b ON a.p = b.p
    QUALIFY row_number() OVER (PARTITION BY a.id, a.p ORDER BY d, b.entry) = 1
  ),"""


def _book(r: int) -> str:
    return f"""
  means{r} AS (
    SELECT p, entry, list(mean::DOUBLE ORDER BY j) AS part FROM (
      SELECT p, entry, j, floor_of.s // floor_of.n AS mean FROM (
        SELECT p, entry, j, {{'s': s - ((s % n) + n) % n, 'n': n}} AS floor_of FROM (
          SELECT p, entry, j, sum(part[j]::BIGINT)::BIGINT AS s, count(*)::BIGINT AS n
          FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(part)) FROM parts) + 1)) AS j)
          GROUP BY p, entry, j
        )
      )
    ) GROUP BY p, entry
  ),
  book{r + 1} AS (
    SELECT b.p, b.entry, coalesce(m.part, b.part) AS part
    FROM book{r} b LEFT JOIN means{r} m ON b.p = m.p AND b.entry = m.entry
  ),"""


OP12 = f"""{_GIVEN}{"".join(_near(r) + _book(r) for r in range(ROUNDS))}{_near(ROUNDS)}
  hashed AS (
    SELECT sha256(string_agg(list_aggregate(list_transform(part, lambda x: x::BIGINT::VARCHAR), 'string_agg', ',')
      , ',' ORDER BY p, entry)) AS codebooks_sha256
    FROM book{ROUNDS}
  ),
  codes AS (
    SELECT id, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY id
  )
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, h.codebooks_sha256
FROM kept k JOIN codes c ON k.id = c.id, hashed h
"""
