"""SQL twins of queries whose results SQL can say, for the comparison on small tables."""

from __future__ import annotations

_LOWERED = "translate(coalesce(\"text\", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {_PLAIN} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS m, array_to_string(w[i:i+12], ' ') AS t
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
places AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
seen AS (SELECT r, i, m, array_to_string(w[i:i+m-1], ' ') AS t FROM places JOIN (SELECT DISTINCT m FROM windows) ON i + m - 1 <= len(w)),
found AS (SELECT DISTINCT r, i, m, item FROM seen JOIN windows USING (m, t)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM found) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

JACCARD = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_SPACED} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM sets x JOIN sets y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * both_ >= 75 * (p.n + q.n - both_)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)
"""

REPEATS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce("text", ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS s FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM docs)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM windows) WHERE k > 1),
edges AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM again),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges) GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before_, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next_ FROM runs),
kept AS (
  SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * before_ + 1, 2 * (a - before_)) || CASE WHEN next_ IS NULL THEN substr(h, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS rest
  FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

# the 256 sums of single bytes, then word by word over the UTF-8 bytes
_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
RESAMPLING = f"""
WITH RECURSIVE steps AS (
  SELECT CAST(b AS BIGINT) AS b, CAST(b AS BIGINT) AS c, 0 AS k FROM range(256) t(b)
  UNION ALL SELECT b, {_CRC_STEP}, k + 1 FROM steps WHERE k < 8),
sums AS (SELECT list(c ORDER BY b) AS s FROM steps WHERE k = 8),
docs AS (SELECT doc_id, row_number() OVER () AS r, {_PLAIN} AS w FROM documents),
items AS (SELECT {_PLAIN} AS w FROM benchmark),
vocabulary AS (SELECT DISTINCT w FROM (SELECT unnest(w) AS w FROM docs UNION ALL SELECT unnest(w) FROM items)),
bytes AS (SELECT w, hex(encode(w)) AS h FROM vocabulary),
listed AS (SELECT w, [CAST(4294967295 AS BIGINT)] || list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)) AS v FROM bytes),
hashed AS (SELECT w, xor(list_reduce(v, lambda c, x: xor(c >> 8, s[xor(c & 255, x) + 1])), 4294967295) % 10000 AS b FROM listed, sums),
words AS (SELECT r, b FROM (SELECT r, unnest(w) AS w FROM docs) JOIN hashed USING (w)),
corpus AS (SELECT b, count(*) AS n FROM words GROUP BY b),
target AS (SELECT b, count(*) AS n FROM (SELECT unnest(w) AS w FROM items) JOIN hashed USING (w) GROUP BY b),
gains AS (
  SELECT corpus.b, floor(1000 * ln(CAST((coalesce(target.n, 0) + 1) * (SELECT sum(n) + 10000 FROM corpus) AS DOUBLE)
    / CAST((corpus.n + 1) * (SELECT coalesce(sum(n), 0) + 10000 FROM target) AS DOUBLE))) AS g
  FROM corpus LEFT JOIN target USING (b)),
weights AS (SELECT r, CAST(sum(g) AS BIGINT) AS weight FROM words JOIN gains USING (b) GROUP BY r),
scored AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS k, count(*) OVER () AS able FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= able * 10 // 100 THEN k END AS rank FROM scored LEFT JOIN ranked USING (r)
"""

HARD_NEGATIVES = """
WITH whole AS (
  SELECT DISTINCT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
usual AS (SELECT len(v) AS d FROM whole GROUP BY d ORDER BY count(*) DESC, d DESC LIMIT 1),
points AS (SELECT vec_id, label, v, row_number() OVER () AS r FROM whole JOIN usual ON len(v) = d),
scored AS MATERIALIZED (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label AS own, p.r AS p, p.vec_id AS id, p.label AS label, CAST(list_dot_product(a.v, p.v) AS BIGINT) AS score
  FROM points a JOIN points p ON a.vec_id % 100 = 0),
positives AS (
  SELECT a, anchor_id, own, p, id AS positive_id, score AS positive_score
  FROM scored WHERE own = label AND anchor_id <> id
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id) <= 5)
SELECT x.anchor_id, positive_id, CAST(row_number() OVER near AS INTEGER) AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM positives x JOIN scored s ON x.a = s.a AND s.label <> x.own AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW near AS (PARTITION BY x.a, x.p ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER near <= 5
"""
