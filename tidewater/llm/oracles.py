"""DuckDB SQL of queries whose columns it can express, written from their contracts."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"


def _spans(kind: str, number: int, pattern: str, ok: str) -> str:
    """Matches of one kind with their places, from the lengths of the texts between them."""
    return rf"""
  SELECT r, {number} AS k, '{kind}' AS name, e - length(m) AS s, e FROM (
    SELECT r, m, v, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM (
      SELECT r, unnest(range(1, len(ms) + 1)) AS i, unnest(gs[:len(ms)]) AS g, unnest(ms) AS m, unnest(vs) AS v FROM (
        SELECT r, regexp_split_to_array(t, {pattern}) AS gs, regexp_extract_all(t, {pattern}) AS ms,
               {f"regexp_extract_all(t, {pattern}, 2)" if kind == "assign" else f"regexp_extract_all(t, {pattern})"} AS vs FROM docs)))
  WHERE {ok}"""


_ASSIGN = r"""'(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'"""
_USER = r"""'(?i:user(?:name)?|login|client_id|account_id)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9@._-]{3,}'"""
_PARTS = " UNION ALL ".join((
    _spans("assign", 0, _ASSIGN, "length(v) >= 6"),
    _spans("access", 1, "'AKIA[A-Z0-9]+'", "length(m) >= 20"),
    _spans("hex", 2, "'[0-9a-f]+'", "length(m) >= 24"),
    # A run of forty base64 characters and of nothing that could go on with it.
    _spans("key", 3, "'[A-Za-z0-9+/=_-]+'", "regexp_full_match(m, '[A-Za-z0-9+/]{40}') AND regexp_matches(m, '[A-Z]') "
           "AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')"),
    _spans("user", 4, _USER, "true"),
    _spans("endpoint", 5, r"'https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/?#@!$&()*+,;=%-]*)?'", "true")))

SECRETS = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({_PARTS}),
flags AS (
  SELECT w.r, w.k, w.name, w.s, w.e, bool_or(p.k IN (1, 4)) AS identifier, bool_or(p.k IN (0, 3)) AS secret, bool_or(p.k = 5) AS place,
         bool_or(p.k <= 2 AND p.s < w.e AND p.e > w.s) AS reported
  FROM parts w JOIN parts p ON w.r = p.r AND w.k > 2 AND p.k <> w.k AND p.s < w.e + 200 AND p.e > w.s - 200
  GROUP BY ALL),
reported AS (
  SELECT r, k, name, s, e FROM parts WHERE k <= 2
  UNION ALL SELECT r, k, name, s, e FROM flags
  WHERE NOT reported AND CASE k WHEN 3 THEN identifier WHEN 4 THEN secret AND place ELSE identifier AND secret END),
told AS (
  SELECT r, k, s, e, concat(name, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)) AS span FROM reported),
lists AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(span, ',' ORDER BY s, k, e) FILTER (k <= 2) AS base, string_agg(span, ',' ORDER BY s, k, e) AS spans
  FROM told GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN lists USING (r)
"""

SUBSTRINGS = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (
  SELECT r, doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
repeated AS (SELECT r, i, f.first < w.doc_id AS again FROM windows w JOIN firsts f USING (h)),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs),
covered AS (
  SELECT words.r, words.i, word,
         coalesce(bool_or(again) OVER (PARTITION BY words.r ORDER BY words.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), false) AS gone
  FROM words LEFT JOIN repeated ON words.r = repeated.r AND words.i = repeated.i),
kept AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text
  FROM covered GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

NGRAMS = rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes a ON a.r = x JOIN sizes b ON b.r = y WHERE 100 * common.n >= 85 * (a.n + b.n - common.n)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(r, root) AS (
  SELECT r, r FROM docs UNION SELECT e.y, reach.root FROM reach JOIN edges e ON e.x = reach.r),
least AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN docs d ON d.r = reach.root GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM docs JOIN least USING (r) LEFT JOIN sizes USING (r)
"""

WARC = """
WITH pages_of AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT *, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM pages_of),
digits AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> (15 - 5 * j)) & 31 AS INTEGER) + 1, 1), '' ORDER BY g, j) AS payload_digest
  FROM (SELECT hex, g, j, CAST(concat('0x', substr(hex, 5 * g + 1, 5)) AS BIGINT) AS v
        FROM (SELECT DISTINCT hex FROM hashed), range(8) a(g), range(4) b(j)) GROUP BY hex),
firsts AS (SELECT payload, min(page_id) AS first FROM hashed GROUP BY payload)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM hashed JOIN digits USING (hex) JOIN firsts USING (payload)
"""
