"""DuckDB SQL for the queries that SQL can express.

The others are tested against brute force or by held-out rows: compression lengths,
XXH64, CRC-32, code-point spans, greedy tiles, trees and forests have no SQL.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
    1.0::DOUBLE + least(len({WORDS}) // 64, 8) / 8.0::DOUBLE AS weight,
    (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':'
      || md5(coalesce(text, ''))), 1, 13) AS UBIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[(place - 1) % 3 + 1] AS w,
    source_size * 2.0::DOUBLE AS top
  FROM totals
), levels AS (
  SELECT *, row_number() OVER (ORDER BY top / w, place) AS n,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(top) OVER before, 0.0::DOUBLE))
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0.0::DOUBLE)) AS level
  FROM weighed
  WINDOW before AS (ORDER BY top / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
  SELECT min_by(level, n) AS level FROM levels WHERE top / w > level
), targets AS (
  SELECT source, source_size,
    CASE WHEN final.level IS NULL THEN top ELSE least(top, final.level * w) END AS target
  FROM levels, final
), classes AS (
  SELECT source, weight, sum(size) AS size FROM sizes GROUP BY source, weight
), class_levels AS (
  SELECT c.source, c.weight,
    CASE WHEN sum(c.size * c.weight) OVER behind > 0 THEN
      (t.target - 2.0::DOUBLE * coalesce(sum(c.size) OVER heavier, 0)) / sum(c.size * c.weight) OVER behind
    END AS level
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW heavier AS (PARTITION BY c.source ORDER BY c.weight DESC
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    behind AS (PARTITION BY c.source ORDER BY c.weight DESC
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), rates AS (
  SELECT source, coalesce(max_by(level, weight) FILTER (WHERE level * weight <= 2),
    2.0::DOUBLE / min(weight)) AS rate
  FROM class_levels GROUP BY source
), rated AS (
  SELECT s.doc_id, s.source, s.size, s.u, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN least(r.rate * s.weight, 2.0::DOUBLE) ELSE 0.0 END AS rate
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
), ranked AS (
  SELECT *, floor(rate) AS whole,
    CASE WHEN rate > floor(rate)
      THEN (u / (1 - u)) / ((rate - floor(rate)) / (1 - (rate - floor(rate)))) END AS rank
  FROM rated
), summed AS (
  SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS open,
    CASE WHEN rank IS NOT NULL THEN
      sum(size) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, CAST(doc_id AS VARCHAR) NULLS FIRST)
        - sum(size) OVER (PARTITION BY source, rank, doc_id) / 2
    END AS middle
  FROM ranked
)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN middle <= open THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""

OP3 = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest
  FROM pages
), firsts AS (
  SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first
  FROM payloads
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM firsts
"""

OP4 = rf"""
WITH texts AS (
  SELECT doc_id, {WORDS} AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS place FROM texts
), windows AS (
  SELECT doc_id, place, array_to_string(words[place:place + 19], ' ') AS w FROM starts
), ordered AS (
  SELECT doc_id, place, row_number() OVER (PARTITION BY w ORDER BY doc_id, place) AS n FROM windows
), removed AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM ordered WHERE n > 1
), gone AS (
  SELECT doc_id, list(place) AS places FROM removed GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(
    CASE WHEN places IS NULL THEN words ELSE
      list_filter(words, lambda x, i: NOT list_contains(places, i)) END, ' '), '')) AS kept_sha256
FROM texts LEFT JOIN gone USING (doc_id)
"""

ORACLE = {"op1_mix": OP1, "op3_warc": OP3, "op4_repeats": OP4}
