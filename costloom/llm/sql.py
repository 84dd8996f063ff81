"""SQL with the same results, for the operators that SQL can express on whole tables."""

from __future__ import annotations

_LINES = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
every AS (SELECT doc_id, unnest(ls) AS raw, generate_subscripts(ls, 1) AS pos FROM split),
line AS (SELECT doc_id, pos, raw, trim(raw, ' ') AS line FROM every),
seen AS (
  SELECT line, string_split(line, ' ') AS w, min({'d': doc_id, 'p': pos}) AS loc
  FROM line WHERE line <> '' GROUP BY line
),
slots AS (SELECT line, w, loc, len(w) AS n, unnest(range(0, len(w))) AS i FROM seen WHERE len(w) >= 5),
shorter AS (
  SELECT line, loc, array_to_string(list_concat(w[1:i], w[i + 2:]), ' ') AS rest, w FROM slots
),
blanked AS (
  SELECT line, loc, min(loc) OVER (
    PARTITION BY n, i, array_to_string(w[1:i], ' '), array_to_string(w[i + 2:], ' ')
  ) AS first_loc FROM slots
),
near AS (
  SELECT line FROM blanked WHERE first_loc < loc
  UNION
  SELECT s.line FROM shorter s JOIN seen b ON b.line = s.rest WHERE b.loc < s.loc
  UNION
  SELECT b.line FROM shorter s JOIN seen b ON b.line = s.rest WHERE s.loc < b.loc
),
judged AS (
  SELECT l.doc_id, l.pos, l.raw,
    CASE WHEN l.line = '' THEN 0
         WHEN s.loc <> {'d': l.doc_id, 'p': l.pos} THEN 1
         WHEN l.line IN (SELECT line FROM near) THEN 2
         ELSE 3 END AS fate
  FROM line l LEFT JOIN seen s ON s.line = l.line
)
SELECT doc_id,
  coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE fate IN (0, 3)), '') AS text,
  count(*) FILTER (WHERE fate > 0) AS n_lines,
  count(*) FILTER (WHERE fate = 1) AS n_exact,
  count(*) FILTER (WHERE fate = 2) AS n_near,
  count(*) FILTER (WHERE fate = 3) AS n_kept
FROM judged GROUP BY doc_id
"""

ORACLE: dict[str, str] = {"op1_line_dedup": _LINES}
