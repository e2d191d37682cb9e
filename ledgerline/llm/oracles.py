"""SQL of the queries that SQL can express."""

from __future__ import annotations

from ledgerline.llm.url_filter import GLOBS, RULES

#: A-Z in lower case, as DuckDB's lower() goes beyond them.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x20\x09-\x0D]+"

DECONTAMINATE = f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{ITEM_WORD}') AS w FROM documents),
iw AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({LOWER}, '{ITEM_WORD}') AS w FROM benchmark),
wins AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS k
         FROM iw, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS u(p) WHERE len(w) > 0),
grams AS (SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS k FROM dw, (SELECT DISTINCT n FROM wins) AS l, unnest(range(1, len(w) - n + 2)) AS u(p)),
found AS (SELECT r, p, grams.n AS n, item FROM grams JOIN wins ON grams.n = wins.n AND grams.k = wins.k),
hits AS (SELECT DISTINCT r, q FROM found, unnest(range(p, p + n)) AS u(q)),
hit AS (SELECT r, count(*) AS n_hit, sum(length(w[q])) AS hit_chars FROM hits JOIN dw USING (r) GROUP BY r),
items AS (SELECT r, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(hit_chars, 0)::BIGINT AS hit_chars
FROM dw LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""


def _url_filter() -> str:
    rules = ", ".join(f"('{rule}', '{rule.partition('/')[0]}', '/{rule.partition('/')[2]}', '{verdict}')" for rule, verdict in RULES)
    part = {glob: glob.removesuffix("*#*").strip("*") for glob, _ in GLOBS}
    other = " ".join(f"WHEN contains(host, '{part[glob]}') THEN '{verdict}'" for glob, verdict in GLOBS)
    return f"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule, h, q, verdict) AS (VALUES {rules}),
best AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM p, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, CASE {other} ELSE 'allow' END) AS verdict FROM p LEFT JOIN best USING (r)
"""


SHARDING = r"""
WITH RECURSIVE bits AS (
  SELECT n::BIGINT AS n, n::BIGINT AS c, 0 AS k FROM range(256) AS r(n)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
jump AS (
  SELECT DISTINCT coalesce(doc_id, 0) AS id, n, coalesce(doc_id, 0)::HUGEINT + CASE WHEN coalesce(doc_id, 0) < 0 THEN 18446744073709551616::HUGEINT ELSE 0::HUGEINT END AS k, -1::BIGINT AS b, 0::BIGINT AS j
  FROM documents, (VALUES (8), (9)) AS sizes(n)
  UNION ALL
  SELECT id, n, k2, j, floor((j + 1)::DOUBLE * (2147483648.0::DOUBLE / ((k2 // 8589934592::HUGEINT)::DOUBLE + 1.0::DOUBLE)))::BIGINT
  FROM (SELECT *, ((k % 4294967296::HUGEINT) * 2862933555777941757::HUGEINT
                   + ((k // 4294967296::HUGEINT) * 2862933555777941757::HUGEINT % 4294967296::HUGEINT) * 4294967296::HUGEINT + 1::HUGEINT) % 18446744073709551616::HUGEINT AS k2
        FROM jump WHERE j < n)),
placed AS (SELECT id, max(CASE WHEN n = 8 THEN b END)::INTEGER AS shard, max(CASE WHEN n = 9 THEN b END)::INTEGER AS grown_shard FROM jump WHERE j >= n GROUP BY id),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
            lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS text_crc32
      FROM documents, tab)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY ((coalesce(doc_id, 0) % 2048 + text_crc32) % 2048 + 2048) % 2048, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM d JOIN placed ON placed.id = coalesce(d.doc_id, 0)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE dw AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + least(len(w), 4) - 1], ' ') AS s FROM dw, unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh AS a JOIN sh AS b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y WHERE 100 * i >= 85 * (p.n + q.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM dw UNION SELECT a, y FROM reach JOIN links ON b = x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(b) FROM reach WHERE a = dw.doc_id) AS component_id FROM dw LEFT JOIN sizes USING (doc_id)
"""

SEARCH_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LEXICAL_SEARCH = f"""
WITH dt AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{SEARCH_TERM}') AS w FROM documents),
it AS (SELECT row_number() OVER () AS i, item_id, unnest(list_distinct(regexp_extract_all({LOWER}, '{SEARCH_TERM}'))) AS t FROM benchmark),
facts AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::HUGEINT AS n_terms FROM dt),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM dt) WHERE t IN (SELECT t FROM it) GROUP BY r, t),
weights AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, facts GROUP BY t, n_docs),
m AS (SELECT r, doc_id, (10 + (90 * len(w) * n_docs) // n_terms)::BIGINT AS m FROM dt, facts WHERE len(w) > 0),
scored AS (SELECT i, item_id, r, doc_id, sum(weights.w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM it JOIN tf USING (t) JOIN weights USING (t) JOIN m USING (r) GROUP BY i, item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {
    "op3_decontaminate": DECONTAMINATE,
    "op4_url_filter": _url_filter(),
    "op9_sharding": SHARDING,
    "op10_ngram_join": NGRAM_JOIN,
    "op11_lexical_search": LEXICAL_SEARCH,
}
