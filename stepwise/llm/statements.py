"""DuckDB statements for the queries of this subpackage that SQL can express.

They share no code and no algorithm with the operators: plain joins over all
words, windows and vectors.
"""

from __future__ import annotations

FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8 = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP10 = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
),
item_words AS (
  SELECT item_id, regexp_extract_all({FOLD}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
),
sizes AS (SELECT item_id, words, least(10, len(words)) AS size FROM item_words WHERE len(words) > 0),
spans AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS span
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM sizes)
),
places AS (
  SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS span
  FROM (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
    FROM doc_words CROSS JOIN (SELECT DISTINCT size FROM spans) WHERE len(words) >= size
  )
),
met AS (SELECT p.doc_id, p.i, p.size, s.item_id FROM places p JOIN spans s USING (size, span)),
hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS word FROM met) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN items i USING (doc_id)
"""

OP11 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         {FOLD} AS folded
  FROM documents
),
words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(folded, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
),
kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30
),
languages AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
own AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM own GROUP BY lang, source),
groups AS (SELECT DISTINCT lang, source FROM docs),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN languages l USING (lang)
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50
"""
