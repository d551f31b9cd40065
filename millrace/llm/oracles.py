"""SQL that the registered corpus queries are checked with, where SQL has a form
for them that is fast enough on whole tables."""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

MIX = """
WITH sizes AS (
  SELECT source, sum(strlen(coalesce(text, '')))::DOUBLE AS bytes FROM documents GROUP BY source
), total AS (
  SELECT sum(bytes) AS bytes,
         list_reduce(list_prepend(0.0::DOUBLE, list(pow(bytes, 0.7) ORDER BY source)), lambda a, b: a + b) AS weight
  FROM sizes
), rates AS (
  SELECT source, CASE WHEN s.bytes = 0 THEN 1.0 ELSE pow(s.bytes, 0.7) / t.weight * t.bytes / s.bytes END AS rate
  FROM sizes s, total t
), pieces AS (
  SELECT source, greatest(1, ceil(rate / 64))::INT AS pieces, rate / greatest(1, ceil(rate / 64)) AS per FROM rates
), terms AS (
  SELECT source, k, exp(-per + k * ln(per) - lgamma(k + 1)) AS p
  FROM pieces, unnest(generate_series(0, ceil(per + 12 * sqrt(per) + 30)::INT)) AS g(k)
), cdf AS (
  SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms
), draws AS (
  SELECT d.doc_id, d.source,
         (('0x' || substr(md5('17|' || d.doc_id || '|' || piece), 1, 12))::BIGINT + 0.5) / 281474976710656 AS u
  FROM documents d JOIN pieces USING (source), unnest(generate_series(1, pieces)) AS g(piece)
), counts AS (
  SELECT doc_id, count(*) FILTER (WHERE c < u)::INT AS n_copies
  FROM draws JOIN cdf USING (source) GROUP BY doc_id
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, n_copies, copy::INT AS copy
FROM documents d JOIN counts USING (doc_id), unnest(generate_series(1, n_copies)) AS g(copy)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS g
  FROM items, unnest(generate_series(1, greatest(1, len(w) - 9))) AS s(i) WHERE len(w) > 0
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM windows) AS sizes, unnest(generate_series(1, len(w) - n + 1)) AS s(i)
), hits AS (
  SELECT DISTINCT doc_id, item_id, i, n FROM grams JOIN windows USING (n, g)
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(generate_series(i, i + n - 1)) AS s(p) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM d, unnest(generate_series(1, greatest(1, len(w) - 4))) AS g(i) WHERE len(w) > 0
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * k >= 85 * (a.n + b.n - k)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM d
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
), lowest AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM lowest LEFT JOIN sizes USING (doc_id)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_sum(list_transform(generate_series(1, len(a.v)), lambda i: a.v[i] * c.v[i]))::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 50 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)
), near AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same
), hard AS (
  SELECT n.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY n.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM near n JOIN scored s
    ON n.anchor_id = s.anchor_id AND NOT s.same AND place <= 5
    AND 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 3
"""
