"""DuckDB texts of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_CRC_TABLE = "tbl AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text by the table ``t``."""
    return f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({text}, ''), lambda ch: ascii(ch))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLES = {
    "op1_url_filter": r"""
WITH rules(rule, host_rule, path_rule, verdict_rule) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
p AS (SELECT row_number() OVER () AS n, page_id,
  translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages)
SELECT any_value(page_id) AS page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(verdict_rule, length(rule)), 'allow') AS verdict
FROM p LEFT JOIN rules ON (host = host_rule OR ends_with(host, '.' || host_rule)) AND starts_with(path, path_rule) GROUP BY n""",
    "op6_warc": r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to FROM q""",
    "op7_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
k AS (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS t FROM k),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
hit AS (SELECT DISTINCT p.doc_id, p.i, p.n, win.item FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM pos) p JOIN win ON p.t = win.t AND p.n = win.n),
cov AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op8_exact_topk": r"""
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE {_CRC_TABLE},
raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k FROM conversations, tbl),
dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM raw),
ids AS (SELECT conv_id, row_number() OVER () AS cid FROM (SELECT DISTINCT conv_id FROM raw)),
num AS (SELECT cid, turn, role, text, rtrim(text, E' \t\n\x0b\x0c\r') AS bare, role[1] AS c,
  row_number() OVER (PARTITION BY cid ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
  row_number() OVER (PARTITION BY cid, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM dam JOIN ids ON dam.conv_id IS NOT DISTINCT FROM ids.conv_id),
r AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  lag(c) OVER (PARTITION BY cid ORDER BY n) AS before FROM num),
stats AS (SELECT cid, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY cid),
moves(s, e, g, price) AS (VALUES (0, 'D', 0, 2), (1, 'D', 1, 2), (2, 'D', 2, 2), (3, 'D', 3, 2), (0, 'K', 1, 0), (0, 'K', 2, 0), (1, 'K', 2, 0), (3, 'K', 2, 0), (2, 'K', 3, 0),
  (0, 'R', 2, 1), (1, 'R', 2, 1), (3, 'R', 2, 1), (2, 'R', 3, 1), (0, 'IR', 3, 6), (1, 'IR', 3, 6), (3, 'IR', 3, 6), (2, 'IR', 2, 6), (0, 'IK', 3, 5), (1, 'IK', 3, 5), (3, 'IK', 3, 5), (2, 'IK', 2, 5)),
step AS (SELECT cid, n, s, e, g, price + CASE WHEN fault = 'truncated' AND e <> 'D' THEN 5 ELSE 0 END AS price,
  CASE WHEN e = 'D' THEN [] ELSE list_concat(CASE WHEN e[1] = 'I' THEN [CASE s WHEN 2 THEN 'assistant:' ELSE 'user:' END] ELSE [] END,
    [CASE WHEN right(e, 1) = 'K' THEN role WHEN g = 2 THEN 'user' ELSE 'assistant' END || ':' || text]) END AS made
  FROM r, moves WHERE e = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (right(e, 1) = 'R' OR c = CASE g WHEN 1 THEN 's' WHEN 2 THEN 'u' ELSE 'a' END))),
path AS (SELECT cid, 0 AS n, 0 AS g, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS made FROM ids
  UNION ALL
  SELECT cid, n, g, b.cost, b.audit, b.made FROM (SELECT p.cid, step.n, step.g, min({{'cost': cost + price, 'audit': audit || e, 'made': list_concat(p.made, step.made)}}) AS b
    FROM path p JOIN step ON p.cid = step.cid AND step.n = p.n + 1 AND step.s = p.g GROUP BY ALL)),
tail AS (SELECT path.cid, CASE g WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END + cost AS cost, audit || CASE g WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS audit,
  list_concat(made, CASE g WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE [] END) AS made
  FROM path JOIN (SELECT ids.cid, count(r.n) AS rows FROM ids LEFT JOIN r ON ids.cid = r.cid GROUP BY 1) t ON path.cid = t.cid AND path.n = t.rows),
best AS (SELECT cid, min({{'cost': cost, 'audit': audit, 'made': made}}) AS b FROM tail GROUP BY cid)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(b.cost AS BIGINT) AS cost, b.audit AS audit, sha256(array_to_string(b.made, chr(10))) AS repaired_sha256 FROM ids LEFT JOIN stats ON ids.cid = stats.cid JOIN best ON ids.cid = best.cid""",
    "op13_periodic_runs": rf"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM documents, tbl),
e AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM e),
i AS (SELECT k, n, a, p, w, unnest(range(n)) AS i FROM f),
pos AS (SELECT k, n, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS word FROM i),
pairs AS (SELECT x.k, x.i, y.i - x.i AS q FROM pos x JOIN pos y ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
isles AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS g FROM pairs),
long AS (SELECT k, q, min(i) AS s, count(*) + q AS n FROM isles GROUP BY k, q, g HAVING count(*) >= greatest(6 - q, 3 * q)),
runs AS (SELECT * FROM long b WHERE NOT EXISTS (SELECT 1 FROM long c WHERE c.k = b.k AND c.q < b.q AND b.q % c.q = 0 AND c.s <= b.s AND c.s + c.n >= b.s + b.n)),
told AS (SELECT k, count(*) AS n_runs, string_agg(concat(s, ',', n, ',', q, chr(10)), '' ORDER BY s, q) AS runs, max(CAST(n AS DOUBLE) / q) AS most FROM runs GROUP BY k),
top AS (SELECT runs.k, min({{'s': s, 'q': q, 'n': n}}) AS r FROM runs JOIN told ON runs.k = told.k AND CAST(n AS DOUBLE) / q = most GROUP BY runs.k),
gone AS (SELECT DISTINCT k, unnest(range(s + q, s + n)) AS i FROM runs),
kept AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS body FROM pos ANTI JOIN gone USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, r.s AS start, r.n AS length, r.q AS period, 1000 * r.n // r.q AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (k) LEFT JOIN top USING (k) LEFT JOIN kept USING (k)""",
}
