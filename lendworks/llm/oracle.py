"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lendworks.llm.queries import CAPTURES

# The eligible texts are compared byte by byte; SHA-256 of the text is part of the result.
EXACT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, sha256(d.text) AS text_sha256, g.keep_id, g.group_size,
       d.doc_id = g.keep_id AS kept
FROM d JOIN g ON d.text = g.text
"""

# Vectors with null or non-finite components take no part; all others are scored against every query.
TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# The same captures; the latest earlier response by comparing all captures of a URL.
REVISITS = """
WITH c AS (__CAPTURES__),
parts AS (
  SELECT *, regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1) AS raw_host,
    regexp_replace(regexp_extract(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(regexp_replace(trim(url), '#.*$', ''), '[?](.*)$', 1), '&'), lambda p:
      p <> '' AND NOT regexp_matches(lower(p), '^(utm_[^=]*|jsessionid|phpsessid|sessionid|sid|ref)(=|$)'))) AS kept
  FROM c),
r AS (
  SELECT record_id, page_id, c, kind, seconds, html,
    regexp_replace(regexp_replace(lower(raw_host), ':(80|443)$', ''), '^www[.]', '')
      || CASE WHEN path = '' THEN '/' ELSE path END
      || CASE WHEN len(kept) = 0 THEN '' ELSE '?' || array_to_string(kept, '&') END AS canonical_url,
    CASE WHEN kind = 'revisit' AND c > 0 AND page_id % 7 = 3 THEN 'stale'
         ELSE sum || CASE WHEN kind = 'response' AND c = 2 THEN '-2' ELSE '-1' END END AS tag,
    kind = 'revisit' AND page_id % 13 = 5 AS dated
  FROM parts),
pairs AS (
  SELECT v.record_id, max_by(p.record_id, p.seconds * 1000000000 + p.record_id) AS refers_to
  FROM r v JOIN r p ON p.canonical_url = v.canonical_url AND p.kind = 'response' AND p.seconds < v.seconds
  WHERE v.kind = 'revisit' GROUP BY v.record_id),
judged AS (
  SELECT v.*, p.record_id AS found, p.html AS found_html, p.tag AS found_tag,
    CASE WHEN v.kind = 'response' THEN 'response' WHEN p.record_id IS NULL THEN 'no_earlier_response'
         WHEN v.dated OR v.tag = p.tag THEN 'resolved' ELSE 'validator_mismatch' END AS resolution
  FROM r v LEFT JOIN pairs USING (record_id) LEFT JOIN r p ON p.record_id = pairs.refers_to)
SELECT record_id, kind, canonical_url, seconds, resolution,
  CASE WHEN resolution = 'resolved' THEN found END AS refers_to,
  CAST(CASE WHEN resolution IN ('resolved', 'response') THEN 200 ELSE 304 END AS INT) AS status,
  'cache-control: max-age=' || c
    || chr(10) || 'content-length: ' || CASE resolution WHEN 'resolved' THEN length(found_html) WHEN 'response' THEN length(html) ELSE 0 END
    || CASE WHEN resolution IN ('resolved', 'response') THEN chr(10) || 'content-type: text/html' ELSE '' END
    || chr(10) || 'date: ' || seconds
    || CASE WHEN NOT dated THEN chr(10) || 'etag: '
              || CASE WHEN kind = 'revisit' AND page_id % 3 = 0 AND tag <> 'stale' THEN 'W/' ELSE '' END || '"' || tag || '"'
            WHEN resolution = 'resolved' THEN chr(10) || 'etag: "' || found_tag || '"' ELSE '' END
    || chr(10) || 'last-modified: Mon, 01 Jan 2024 00:00:00 GMT'
    || CASE WHEN resolution IN ('resolved', 'response') THEN chr(10) || 'x-served: origin' ELSE '' END AS headers,
  CASE resolution WHEN 'resolved' THEN found_html WHEN 'response' THEN html END AS payload
FROM judged
"""

# P(X <= k) as a running sum; the uniform number is hashed as in the query.
MIXING = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT sum(n) FROM counts) * sqrt(n) / (SELECT sum(sqrt(n)) FROM counts) / n AS rate FROM counts),
parts AS (SELECT source, rate, CAST(greatest(ceil(rate / 16.0), 1) AS INT) AS parts FROM rates),
tables AS (
  SELECT source, parts, k,
         sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)))
           OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS reached
  FROM parts, range(0, 81) AS t(k)),
draws AS (
  SELECT d.doc_id, d.source, j.part,
         (CAST('0x' || substr(md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || j.part), 1, 13) AS BIGINT)
          + 0.5) / 4503599627370496.0 AS u
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, range(1, p.parts + 1) AS j(part)),
copies AS (
  SELECT w.doc_id, count(*) AS copies
  FROM draws w JOIN tables t ON w.source IS NOT DISTINCT FROM t.source AND t.reached < w.u GROUP BY w.doc_id)
SELECT d.*, CAST(c.copy AS INT) AS copy
FROM documents d JOIN copies n ON d.doc_id IS NOT DISTINCT FROM n.doc_id, range(1, n.copies + 1) AS c(copy)
"""


# CRC-32 through its table of 256 remainders. A node is the text of its turns; every node is paired with its ancestors.
TRIE = """
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base, CAST(xor(list_reduce(
      list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
      lambda c, b: xor(t[CAST(xor(c, b) & 255 AS INT) + 1], c >> 8)), 4294967295) % 6 AS INT) AS h
  FROM own, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.base),
members AS (
  SELECT conv_id, d AS depth, md5(CAST(to_json(turns[1:d]) AS VARCHAR)) || d AS node,
         CASE WHEN d > 0 THEN md5(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) || (d - 1) END AS parent,
         CASE WHEN d = 0 THEN 0 ELSE length(turns[d].t) END AS chars, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT node, depth, any_value(parent) AS parent, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM members GROUP BY node, depth),
counted AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.parent = n.node) AS n_children FROM nodes n),
below AS (
  SELECT a.node, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM counted n JOIN members a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.node)
SELECT c.conv_id, c.depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.node = c.node LEFT JOIN nodes p ON p.node = c.parent
"""


def oracle_sql() -> dict[str, str]:
    captures = CAPTURES.format(pages="(SELECT *, unnest([0, 1, 2]) AS c FROM pages)")
    return {"op5_revisits": REVISITS.replace("__CAPTURES__", captures), "op4_top_k": TOP_K, "op3_mix_sources": MIXING, "op10_exact_dedup": EXACT, "op13_conversation_trie": TRIE}
