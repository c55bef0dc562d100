"""DuckDB counterparts of the corpus queries that SQL can state, by brute force."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda j: array_to_string(w[j:j + 4], ' ')) END) AS g FROM docs)
), sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (SELECT doc_id AS id, doc_id AS r FROM documents UNION SELECT reach.id, pairs.b FROM reach JOIN pairs ON pairs.a = reach.r),
comp AS (SELECT id, min(r) AS c FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN comp c ON c.id = d.doc_id
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(13, len(w)) AS k FROM (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(w[j:j + k - 1], ' ') AS g FROM (SELECT item, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM items)),
grams AS (SELECT doc_id, k, j, array_to_string(w[j:j + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM docs, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT g.doc_id, g.j, g.k, x.item FROM grams g JOIN windows x ON x.k = g.k AND x.g = g.g),
cover AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(j, j + k)) AS i FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN cover c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS id, vec_id AS r FROM embeddings UNION SELECT reach.id, pairs.b FROM reach JOIN pairs ON pairs.a = reach.r),
comp AS (SELECT id, min(r) AS c FROM reach GROUP BY id), links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(l.n, 0) AS n_links, c.c AS component_id, e.vec_id = c.c AS kept FROM embeddings e JOIN comp c ON c.id = e.vec_id LEFT JOIN links l ON l.a = e.vec_id
"""
