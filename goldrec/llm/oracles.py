"""The SQL counterparts of the corpus queries that SQL can express, for DuckDB."""

from __future__ import annotations

import string

WORD = r"[^\x20\x09-\x0D]+"

#: Every query against every vector, in whole numbers.
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

#: Sets of five words, all pairs that share one, and the components of those that link.
JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}') AS w
  FROM documents),
cut AS (
  SELECT doc_id, CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END AS s
  FROM words WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, unnest(s) AS s FROM cut),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(a, b) AS (SELECT a, b FROM edges UNION SELECT reached.a, edges.b FROM reached JOIN edges ON reached.b = edges.a),
least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, least(d.doc_id, coalesce(least.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON least.a = d.doc_id"""

#: The checksum bit by bit; every prefix of every conversation; sums over the prefixes below each.
TRIE = """
WITH own AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
summed AS (
  SELECT c, l, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda y, z: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))), 4294967295::UBIGINT) % 9 AS h
  FROM own),
built AS (
  SELECT o.c, list_concat(coalesce(b.l[1:CAST(o.h AS BIGINT)], []), o.l[CAST(o.h AS BIGINT) + 1:]) AS l
  FROM summed o LEFT JOIN own b ON b.c = o.c - o.c % 5),
prefixes AS (SELECT c, len(l) AS n, d, l[1:d] AS p FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM built)),
nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '') AS ends
  FROM prefixes GROUP BY p, d),
children AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
known AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON nodes.d = children.d AND nodes.p = children.p),
below AS (
  SELECT p[1:u] AS p, u AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
    sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(p[d].t)) END) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM known) GROUP BY ALL)
SELECT k.conv_id, CAST(k.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children, CAST(below.n_leaves AS BIGINT) AS n_leaves,
  CAST(below.saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM known k JOIN below ON k.d = below.d AND k.p = below.p LEFT JOIN known up ON up.d = k.d - 1 AND up.p = k.p[1:k.d - 1]"""

ORACLES = {"op2_top_k": TOP_K, "op4_jaccard_join": JACCARD, "op11_prefix_trie": TRIE}
