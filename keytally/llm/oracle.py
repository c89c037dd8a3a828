"""DuckDB SQL for the operators' queries that SQL can express."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

ORACLE_SQL["op2_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
  FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

#: Three-word shingles of every document, links by exact set sizes, components by a recursive walk.
ORACLE_SQL["op8_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sh AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w
), t AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sh),
i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n
  FROM t a JOIN t b ON a.token = b.token AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY 1, 2
), links AS (SELECT a, b FROM i WHERE 100 * n >= 90 * (na + nb - n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
walk AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION SELECT walk.node, edges.b FROM walk JOIN edges ON edges.a = walk.seen
), least AS (SELECT node, min(seen) AS component_id FROM walk GROUP BY node)
SELECT sh.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
FROM sh JOIN least ON least.node = sh.doc_id
"""

#: Terms with their counts, weights from counts over all documents, integer scores, the 20 best of each item.
ORACLE_SQL["op12_lexical_search"] = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), d AS (SELECT r, doc_id, w, len(w) AS n FROM words WHERE len(w) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) GROUP BY r, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, c GROUP BY term
), v AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)) AS x FROM tf, c
), q AS (
  SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), s AS (
  SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, CAST(sum(w * x) AS BIGINT) AS score
  FROM q JOIN weight USING (term) JOIN v USING (term) GROUP BY i, r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""
