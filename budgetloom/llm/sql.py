"""DuckDB counterparts of the operator queries that SQL can express."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"

LINE_DEDUP = rf"""
WITH raw AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS body, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents),
lines AS (SELECT doc_id, line::INT AS line, list_filter(string_split_regex(body, '{_SPACE}'), lambda w: w <> '') AS w FROM raw),
told AS (SELECT doc_id, line, w FROM lines WHERE len(w) > 0),
firsts AS (SELECT w, min({{'d': doc_id, 'l': line}}) AS f FROM told GROUP BY w),
able AS (SELECT w, f, len(w) AS n FROM firsts WHERE len(w) >= 8),
cut AS (SELECT f, n, p, w[1:p - 1] || w[p + 1:] AS v FROM (SELECT w, f, n, unnest(range(1, n + 1)) AS p FROM able)),
pairs AS (
  SELECT a.f AS a, min(b.f) AS b FROM cut a JOIN cut b ON a.v = b.v AND a.p = b.p AND a.n = b.n AND b.f < a.f GROUP BY 1
  UNION ALL SELECT greatest(a.f, b.f), least(a.f, b.f) FROM cut a JOIN able b ON a.v = b.w
),
near AS (SELECT a, min(b) AS b FROM pairs GROUP BY a),
marked AS (
  SELECT doc_id, line, f <> {{'d': doc_id, 'l': line}} AS exact, least(CASE WHEN f <> {{'d': doc_id, 'l': line}} THEN f END, b) AS kept
  FROM told JOIN firsts USING (w) LEFT JOIN near ON near.a = firsts.f
)
SELECT d.doc_id, count(m.line) AS n_lines, count(*) FILTER (kept IS NOT NULL AND exact) AS n_exact, count(*) FILTER (kept IS NOT NULL AND NOT exact) AS n_near,
  coalesce(string_agg(m.line || ':' || kept.d || ':' || kept.l, ',' ORDER BY m.line) FILTER (kept IS NOT NULL), '') AS dropped
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""

_RULES = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0),
]


def _spans(rank: int, name: str, pattern: str, group: int, least: int) -> str:
    gaps = f"list_transform(string_split_regex(t, '{pattern}'), lambda x: len(x))"
    sizes = f"list_transform(regexp_extract_all(t, '{pattern}'), lambda x: len(x))"
    values = f"regexp_extract_all(t, '{pattern}', {group})"
    return f"""SELECT doc_id, {rank} AS rank, '{name}' AS kind, list_sum(g[:i]) + coalesce(list_sum(s[:i - 1]), 0) AS b, s[i] AS size, len(v[i]) >= {least} AS ok
FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM (SELECT doc_id, {gaps} AS g, {sizes} AS s, {values} AS v FROM texts))"""


SECRET_SCAN = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_spans(i, *r) for i, r in enumerate(_RULES))}),
spans AS (SELECT doc_id, rank, kind, b, kind || ':' || b::BIGINT || ':' || (b + size)::BIGINT AS span FROM found WHERE ok)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(span, ',' ORDER BY b, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(span, ',' ORDER BY b, rank), '') AS spans
FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

EXACT_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM pairs
QUALIFY rank <= 20
"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS id, doc_id AS c FROM documents UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.id)
SELECT s.doc_id, len(s.s) AS n_shingles, min(r.c) AS component_id FROM sets s JOIN reach r ON r.id = s.doc_id GROUP BY ALL
"""

SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
parts AS (SELECT doc_id, c, substr(x, 1000 * c + 1, 1098) AS y FROM (SELECT doc_id, x, unnest(range(0, len(x) // 1000 + 1)) AS c FROM texts)),
strings AS (SELECT doc_id, 500 * c + i AS p, substr(y, 2 * i + 1, 100) AS s FROM (SELECT *, unnest(range(0, least(len(y) // 2 - 49, 500))) AS i FROM parts)),
firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT DISTINCT doc_id, p FROM strings JOIN firsts USING (s) WHERE first < doc_id),
runs AS (SELECT doc_id, p, sum(CASE WHEN p <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT *, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hits)),
spans AS (SELECT doc_id, min(p) AS b, max(p) + 50 AS e FROM runs GROUP BY doc_id, run),
gaps AS (SELECT doc_id, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY b) AS b, b AS e FROM spans
  UNION ALL SELECT t.doc_id, coalesce(max(s.e), 0), len(any_value(t.x)) // 2 FROM texts t LEFT JOIN spans s USING (doc_id) GROUP BY t.doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) AS k FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, len(x) // 2 AS n_bytes, (len(x) - len(k)) // 2 AS n_removed, (SELECT count(*) FROM spans s WHERE s.doc_id = t.doc_id) AS n_spans, sha256(from_hex(k)) AS kept_sha256
FROM texts t JOIN kept USING (doc_id)
"""

SPELLING = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS crc FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
counts AS (SELECT doc_id, run, count(*) AS n, hex(encode(doc_id || ':' || run)) AS x FROM runs WHERE len(run) >= 7 GROUP BY ALL),
bytes AS (SELECT run, n, list_transform(range(1, len(x), 2), lambda i: (strpos('0123456789ABCDEF', x[i]) - 1) * 16 + strpos('0123456789ABCDEF', x[i + 1]) - 1) AS b FROM counts),
hashes AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, v: xor(c >> 8, crc[(xor(c, v) & 255) + 1])), 4294967295) AS h FROM bytes, crc_table),
changed AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM hashes),
words AS (SELECT word, sum(n)::BIGINT AS n FROM changed WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, p, word[:p - 1] || word[p + 1:] AS v FROM (SELECT *, unnest(range(1, len(word) + 1)) AS p FROM words)),
pairs AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.v = b.v AND a.p = b.p AND len(a.word) = len(b.word) AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.v = b.word UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.v = b.word),
near AS (SELECT a AS word, count(*) AS n_near, min({'least': -w.n, 'other': b}) AS best FROM pairs JOIN words w ON w.word = b GROUP BY a),
found AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.least >= 10 * n THEN best.other END AS form, CASE WHEN -best.least >= 10 * n THEN -best.least END AS form_n
  FROM words w LEFT JOIN near USING (word)),
ends AS (SELECT word, word AS root FROM found WHERE form IS NULL UNION ALL SELECT f.word, e.root FROM ends e JOIN found f ON f.form = e.word)
SELECT word, form, root, n, n_near, form_n FROM found JOIN ends USING (word)
"""

ORACLES = {"op1_line_dedup": LINE_DEDUP, "op2_secret_scan": SECRET_SCAN, "op7_exact_top_k": EXACT_TOP_K, "op8_ngram_jaccard": NGRAM_JACCARD, "op11_suffix_dedup": SUFFIX_DEDUP, "op12_spelling_variants": SPELLING}
