"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(x: str) -> str:
    """A-Z lower-cased, nothing else."""
    return f"translate({x}, '{_UP}', '{_LOW}')"


_OP1 = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM t),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b
  WHERE 100 * p.o >= 85 * (na.n + nb.n - p.o)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(r.c) AS component_id FROM n JOIN r ON r.doc_id = n.doc_id GROUP BY 1, 2
"""

_OP4 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM (
    SELECT item, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM iw) WHERE len(w) >= k)),
o AS (SELECT dw.doc_id, dw.k, dw.p, iw.item FROM dw JOIN iw ON dw.k = iw.k AND dw.g = iw.g),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM o) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.l, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""

_OP8 = rf"""
WITH d AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
k AS (SELECT doc_id, p, line, {_lower(r"regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')")} AS key FROM d),
r AS (SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
f AS (SELECT k.doc_id, k.p, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS lost FROM k LEFT JOIN r ON r.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT lost), '')) AS kept_sha256
FROM f GROUP BY doc_id
"""

_OP5 = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda x, y: x + y)) AS score
  FROM v q JOIN v c
  ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) <= 10
"""

_OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM r
"""

SQL = {
    "op1_ngram_jaccard": _OP1,
    "op4_decontaminate": _OP4,
    "op5_nearest_neighbours": _OP5,
    "op8_line_dedup": _OP8,
    "op10_warc": _OP10,
}
