"""Reference SQL of the newer operators, by plain window functions and joins."""

from __future__ import annotations

#: The 256 steps of crc32, and the macro-like expression that folds the bytes of {} with them.
STEPS = """steps AS (
  SELECT list(list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1],
    lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS step
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
)"""


def crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a string's UTF-8 bytes; needs `STEPS` in scope."""
    return f"""xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(range(1, octet_length(encode({text})) + 1),
        lambda i: CAST(('0x' || substr(hex(encode({text})), 2 * i - 1, 2)) AS BIGINT))),
      lambda a, b: xor(a >> 8, step[xor(a % 256, b) + 1])), 4294967295)"""


_FEATURES = r"""
  SELECT row, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
"""
_WORDS = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w"""

OP12 = f"""
WITH {STEPS}, docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS} FROM documents
), wanted AS (
  SELECT row_number() OVER () AS row, {_WORDS} FROM benchmark
), of_docs AS ({_FEATURES} FROM docs), of_wanted AS ({_FEATURES} FROM wanted),
buckets AS (
  SELECT f, {crc32("f")} % 10000 AS bucket
  FROM (SELECT f FROM of_docs UNION SELECT f FROM of_wanted), steps
), s AS (SELECT bucket, count(*) AS n FROM of_docs JOIN buckets USING (f) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS n FROM of_wanted JOIN buckets USING (f) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    CAST((coalesce(t.n, 0) + 1) * ((SELECT count(*) FROM of_docs) + 10000) AS DOUBLE)
    / CAST((s.n + 1) * ((SELECT count(*) FROM of_wanted) + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)
), weights AS (
  SELECT row, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM of_docs JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY row
), scores AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST(('0x' || substr(sha256('7:' || doc_id), 1, 8)) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (row)
), ranks AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place FROM scores
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_words >= 20 AND place <= (SELECT count(*) FROM scores WHERE n_words >= 20) * 25 // 100
  THEN place END AS rank
FROM ranks
"""

OP11 = f"""
WITH {STEPS}, turns AS (
  SELECT conv_id, turn, octet_length(encode(coalesce(text, ''))) AS size,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
  FROM conversations WHERE conv_id IS NOT NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM turns
), convs AS (
  SELECT c, c - c % 5 AS base, {crc32("CAST(c AS VARCHAR)")} % 9 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM turns), steps
), heads AS (
  SELECT c, pos AS d, size, digest FROM convs JOIN numbered ON conv_id = base AND pos <= h
), own AS (
  SELECT c, pos - h + (SELECT count(*) FROM heads WHERE heads.c = convs.c) AS d, size, digest
  FROM convs JOIN numbered ON conv_id = c AND pos > h
), rebuilt AS (SELECT * FROM heads UNION ALL SELECT * FROM own
), paths AS (
  SELECT c, d, size, string_agg(digest, '') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs
), nodes AS (
  SELECT d, path, min(c) AS conv_id, count(*) AS n, min(size) AS size FROM paths GROUP BY d, path
), ends AS (
  SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
  FROM (SELECT c, path FROM paths QUALIFY row_number() OVER (PARTITION BY c ORDER BY d DESC) = 1)
  GROUP BY path
), children AS (
  SELECT v.path, count(*) AS n FROM nodes v JOIN nodes u ON u.d = v.d + 1 AND starts_with(u.path, v.path)
  GROUP BY v.path
), subtrees AS (
  SELECT v.path, sum((u.n - 1) * u.size) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
  FROM nodes v JOIN nodes u ON starts_with(u.path, v.path) LEFT JOIN children k ON k.path = u.path
  GROUP BY v.path
)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n AS n_convs,
  coalesce(k.n, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes v JOIN subtrees USING (path)
LEFT JOIN children k ON k.path = v.path
LEFT JOIN ends ON ends.path = v.path
LEFT JOIN nodes p ON v.d > 0 AND p.path = substr(v.path, 1, CAST(32 * (v.d - 1) AS BIGINT))
"""
