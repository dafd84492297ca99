"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from corpusloom.llm.manifest_sql import OP13
from corpusloom.llm.vector_sql import OP12

MIX_TARGETS = r"""
  sized AS (
    SELECT doc_id, source,
      coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
  ),
  sources AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM (
      SELECT source, sum(size)::BIGINT AS source_size,
        greatest(sum(size)::BIGINT // count(*), 1) AS mean
      FROM sized GROUP BY source
    )
  ),
  -- In order of size for weight the sources fill up one after the other; the level is that of the first that does not.
  filling AS (
    SELECT *,
      coalesce(sum(2 * source_size) OVER before, 0)::DOUBLE AS filled,
      sum(weight) OVER from_here AS weights
    FROM sources
    WINDOW before AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      from_here AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  ),
  levels AS (
    SELECT *, ((SELECT 1.5::DOUBLE * sum(source_size) FROM sources) - filled) / weights AS level,
      2.0::DOUBLE * source_size / weight AS full_at
    FROM filling
  ),
  water AS (SELECT coalesce(arg_min(level, full_at) FILTER (level < full_at), 0) AS level FROM levels),
  goals AS (
    SELECT source, source_size, mean, least(2.0::DOUBLE * source_size, water.level * weight) AS target
    FROM sources, water
  )
"""

OP7 = f"""
WITH {MIX_TARGETS},
  units AS (SELECT doc_id, source, size, count(*)::BIGINT AS n FROM sized GROUP BY ALL),
  known AS (
    SELECT u.*, g.source_size, g.target, (1000 * size) // (size + mean) AS lean,
      CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS ratio
    FROM units u JOIN goals g ON u.source IS NOT DISTINCT FROM g.source
  ),
  leant AS (
    SELECT *, floor(ratio) AS whole, ratio - floor(ratio) AS f,
      (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::UBIGINT::DOUBLE + 0.5::DOUBLE)
        / 4503599627370496::DOUBLE AS u,
      coalesce((sum(n * size * lean) OVER (PARTITION BY source))::DOUBLE
        / nullif(sum(n * size) OVER (PARTITION BY source), 0)::DOUBLE, 0) AS lean_mean
    FROM known
  ),
  placed AS (
    SELECT *, f + f * (1 - f) * ((lean - lean_mean) / 1000) AS inclusion, target - whole * source_size AS rest
    FROM leant
  ),
  ranked AS (
    SELECT *, CASE WHEN f > 0 THEN (u / (1 - u)) * ((f / (1 - f)) / (inclusion / (1 - inclusion))) END AS odds
    FROM placed
  ),
  summed AS (
    SELECT *, coalesce(sum(n * size) OVER (
      PARTITION BY source, odds IS NULL ORDER BY odds / (1 + odds), doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM ranked
  ),
  decided AS (
    SELECT *, whole::BIGINT + CASE WHEN odds IS NOT NULL AND 2 * before + n * size <= 2 * rest THEN 1 ELSE 0 END AS copies
    FROM summed
  )
SELECT s.doc_id, s.size, d.source_size, d.target, d.copies * s.size AS taken
FROM sized s JOIN decided d
  ON s.doc_id IS NOT DISTINCT FROM d.doc_id AND s.source IS NOT DISTINCT FROM d.source AND s.size = d.size
"""

LLM_ORACLES: dict[str, str] = {"op7_mixing": OP7, "op12_vector_codes": OP12, "op13_merkle_manifest": OP13}
