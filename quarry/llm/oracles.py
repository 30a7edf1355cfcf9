"""DuckDB SQL for the contract queries that SQL can express, over the tables `documents` and `benchmark`."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS spot, unnest(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS s
  FROM d WHERE len(w) >= 20 AND doc_id IS NOT NULL),
late AS (SELECT doc_id, spot FROM win QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, spot) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(spot, spot + 20)) AS pos FROM late),
word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text
  FROM (SELECT word.* FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.pos = gone.pos) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN lost ON d.doc_id = lost.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(text=_LOWERED)} AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) AS s
  FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, b.y FROM reach JOIN both_ways b ON reach.r = b.x),
comp AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN comp ON comp.doc_id = d.doc_id
"""

DECONTAMINATION = rf"""
WITH said AS (SELECT 'd' AS of, doc_id AS id, NULL AS item, text FROM documents UNION ALL SELECT DISTINCT 'b', NULL, CAST(item_id AS VARCHAR), text FROM benchmark),
cut AS (SELECT of, id, item, list_filter(regexp_split_to_array({_LOWERED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM said),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS len, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1), lambda i: array_to_string(w[i:i + 12], ' '))) AS s
  FROM cut WHERE of = 'b' AND len(w) > 0),
lens AS (SELECT DISTINCT len FROM win),
d AS (SELECT row_number() OVER () AS row, id AS doc_id, w FROM cut WHERE of = 'd'),
place AS (
  SELECT row, lens.len, unnest(range(1, len(w) - lens.len + 2)) AS spot, unnest(list_transform(range(1, len(w) - lens.len + 2), lambda i: array_to_string(w[i:i + lens.len - 1], ' '))) AS s
  FROM d, lens WHERE len(w) >= lens.len),
occ AS (SELECT row, spot, place.len, item FROM place JOIN win ON place.len = win.len AND place.s = win.s),
hit AS (SELECT row, count(DISTINCT pos) AS n FROM (SELECT row, unnest(range(spot, spot + len)) AS pos FROM (SELECT DISTINCT row, spot, len FROM occ)) GROUP BY row),
named AS (SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item FROM occ) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.row = d.row LEFT JOIN named ON named.row = d.row
"""

SQL = {"op3_substring_dedup": SUBSTRING_DEDUP, "op7_near_dedup": NEAR_DEDUP, "op8_decontamination": DECONTAMINATION}
