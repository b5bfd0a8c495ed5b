"""SQL of the training-data queries that an SQL engine can express over whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

LOWER = "translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Windows of each item and the stretches of documents with as many words, met by their text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ORACLE["op2_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format(c='text')}, '{WORD}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format(c='text')}, '{WORD}') AS ws FROM benchmark),
spans AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w FROM spans),
places AS (SELECT d.doc_id, d.ws, l.n, unnest(range(1, len(d.ws) - l.n + 2)) AS i
  FROM d, (SELECT DISTINCT n FROM windows) l WHERE len(d.ws) >= l.n),
met AS (SELECT p.doc_id, p.i, p.n, w.item_id FROM (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w FROM places) p
  JOIN windows w ON w.n = p.n AND w.w = p.w),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT CAST(d.doc_id AS BIGINT) AS doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id"""

# All pairs that share a shingle, and everything reachable by links.
TOKEN = r"[^\x20\x09-\x0D]+"
ORACLE["op3_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER.format(c='text')}, '{TOKEN}') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh FROM w),
g AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS node, doc_id AS label FROM s UNION SELECT e.b, r.label FROM reach r JOIN e ON e.a = r.node)
SELECT CAST(s.doc_id AS BIGINT) AS doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, CAST(c.component_id AS BIGINT) AS component_id
FROM s JOIN (SELECT node, min(label) AS component_id FROM reach GROUP BY node) c ON c.node = s.doc_id"""
