"""The queries that plain SQL can express, for an independent engine on the same tables."""

from __future__ import annotations

# Each of the 32 characters takes five bits of the digest; two hexadecimal digits hold them.
WARC = """WITH payloads AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) || '0' AS hex FROM pages),
firsts AS (SELECT hex, max(page_id) AS top FROM payloads GROUP BY hex),
marked AS (SELECT p.*, f.top, f.top IS NOT NULL AND p.page_id IS DISTINCT FROM f.top AS again FROM payloads p JOIN firsts f USING (hex))
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (
    ((16 * (instr('0123456789abcdef', substr(hex, CAST(5 * i // 4 + 1 AS INTEGER), 1)) - 1)
      + instr('0123456789abcdef', substr(hex, CAST(5 * i // 4 + 2 AS INTEGER), 1)) - 1) >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN top END AS refers_to
FROM marked"""

INNER_PRODUCT = """WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS z FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.z, c.z), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id AND len(c.z) = len(q.z) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10"""

SIMILARITY = """WITH RECURSIVE listed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM listed),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
steps AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS label FROM documents UNION SELECT s.b, r.label FROM reached r JOIN steps s ON s.a = r.node)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.label) AS component_id
FROM documents d JOIN reached r ON r.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


NEAR_DUPLICATES = """WITH RECURSIVE listed AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM listed),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
steps AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id AS node, doc_id AS label FROM documents UNION SELECT s.b, r.label FROM reached r JOIN steps s ON s.a = r.node)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.label) AS component_id, d.doc_id = min(r.label) AS kept
FROM documents d JOIN reached r ON r.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""

# crc32 of each distinct word, byte by byte, with the table of the reflected polynomial made by its rule.
RESAMPLING = """WITH words AS MATERIALIZED (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM documents),
aims AS MATERIALIZED (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark),
steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
every AS (SELECT w, hex(w) AS h, strlen(w) AS size FROM (SELECT w FROM words UNION SELECT w FROM aims)),
placed AS MATERIALIZED (
  SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(size), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 10000 AS bucket FROM every, steps),
s AS (SELECT bucket, count(*) AS n FROM words JOIN placed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM aims JOIN placed USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT count(*) FROM words) AS all_s, (SELECT count(*) FROM aims) AS all_t),
gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (all_s + 10000) / (CAST(s.n + 1 AS DOUBLE) * (all_t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), sums),
weights AS (SELECT doc_id, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN placed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS fit FROM scored WHERE n_features >= 20)
SELECT d.doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= 10 * fit // 100 THEN place END AS rank
FROM scored d LEFT JOIN ranked USING (doc_id)"""


def all_sql() -> dict[str, str]:
    return {"op1_warc": WARC, "op7_kdtree": INNER_PRODUCT, "op9_similarity": SIMILARITY, "op11_resampling": RESAMPLING, "op13_minhash": NEAR_DUPLICATES}
