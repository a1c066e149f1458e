"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, pos + 1, pos + 10), ' ') AS words
  FROM i, UNNEST(range(0, greatest(1, len(w) - 9))) AS u(pos) WHERE len(w) > 0),
places AS (
  SELECT rid, pos, n, array_to_string(list_slice(w, pos + 1, pos + n), ' ') AS words
  FROM d, (SELECT DISTINCT n FROM windows) AS s, UNNEST(range(0, greatest(0, len(w) - n + 1))) AS u(pos)),
found AS (SELECT rid, pos, places.n, item_id FROM places JOIN windows ON places.n = windows.n AND places.words = windows.words),
words AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, UNNEST(range(pos, pos + n)) AS k FROM found) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= 3
"""

_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
    lambda x, zero: CASE WHEN x % 2 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)), CAST(4294967295 AS BIGINT))"""

CONVERSATION_TRIE = rf"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
starts AS (SELECT conv_id, {_CRC32} % 4 AS h, turns FROM own),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(list_slice(b.turns, 1, h), []), list_slice(s.turns, h + 1, len(s.turns))) AS turns
  FROM starts AS s LEFT JOIN own AS b ON b.conv_id = s.conv_id - s.conv_id % 20),
passed AS (
  SELECT conv_id, d, list_slice(turns, 1, d) AS prefix, d = len(turns) AS ends FROM rebuilt, UNNEST(range(0, len(turns) + 1)) AS u(d)),
nodes AS (
  SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS ids,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(prefix[d].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM passed GROUP BY prefix, d),
children AS (SELECT list_slice(prefix, 1, d - 1) AS prefix, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
weighed AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (prefix, d)),
sums AS (
  SELECT list_slice(prefix, 1, up) AS prefix, up AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM weighed, UNNEST(range(0, d + 1)) AS u(up) GROUP BY 1, 2)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  sha256(coalesce(w.ids, '')) AS ends_sha256
FROM weighed AS w JOIN sums AS s ON s.prefix = w.prefix AND s.d = w.d
LEFT JOIN nodes AS p ON p.d = w.d - 1 AND p.prefix = list_slice(w.prefix, 1, w.d - 1)
"""
