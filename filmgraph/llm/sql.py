"""DuckDB statements of the queries that SQL can express, over the raw driver tables."""

from __future__ import annotations

from . import line_rules, url_rules
from .common import WORD_PATTERN

_RULES = line_rules.LineRules()
_END = line_rules.SENTENCE_END.replace("'", "''")


def line_rules_sql(table: str = "documents") -> str:
    """Counts and verdict per row of ``table``; rows are told apart by a row number."""
    r = _RULES
    words = f"regexp_extract_all({{}}, '{WORD_PATTERN}')"

    def count(pattern: str) -> str:
        return f"len(regexp_extract_all(line, '{pattern}'))"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM {table}),
w AS (SELECT rid, doc_id, text, {words.format('text')} AS ws FROM d),
base AS (SELECT rid, doc_id, len(ws) AS n_words,
    coalesce(list_sum([length(x) FOR x IN ws]), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols FROM w),
pos AS (SELECT rid, unnest(range(1, len(ws) - 1)) AS p, ws FROM w WHERE len(ws) >= 3),
win AS (SELECT rid, p, ws[p] AS a, ws[p + 1] AS b, ws[p + 2] AS c FROM pos),
dup AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win)
    WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p + k) AS n FROM dup, range(3) AS t(k) GROUP BY rid),
raw AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT rid, line, {words.format('line')} AS ws FROM raw),
own AS (SELECT rid, line, len(ws) AS n, list_sum([length(x) FOR x IN ws]) AS chars
    FROM lines WHERE len(ws) > 0),
judged AS (SELECT *, CASE
    WHEN 100 * {count(line_rules.NAV_SEPARATOR)} > {r.nav_percent} * n THEN 'nav'
    WHEN 100 * {count('[#*$%&|<>]')} > {r.symbol_percent} * n
      OR 100 * {count(line_rules.SHOUT)} > {r.shout_percent} * n THEN 'noise'
    WHEN n <= {r.boilerplate_words}
      AND regexp_matches(line, '{line_rules.BOILERPLATE}') THEN 'boilerplate'
    WHEN n < {r.unpunctuated_words} AND NOT regexp_matches(line, '{_END}') THEN 'fragment'
    END AS rule FROM own),
by_line AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
    coalesce(sum(chars) FILTER (rule IS NOT NULL), 0)::BIGINT AS lost_chars,
    count(*) FILTER (rule = 'nav') AS nav_lines, count(*) FILTER (rule = 'noise') AS noise_lines,
    count(*) FILTER (rule = 'boilerplate') AS boilerplate_lines,
    count(*) FILTER (rule = 'fragment') AS fragment_lines FROM judged GROUP BY rid),
every AS (SELECT doc_id, n_words, word_chars, n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(lost_chars, 0) AS lost_chars, coalesce(nav_lines, 0) AS nav_lines,
    coalesce(noise_lines, 0) AS noise_lines, coalesce(boilerplate_lines, 0) AS boilerplate_lines,
    coalesce(fragment_lines, 0) AS fragment_lines
    FROM base LEFT JOIN rep USING (rid) LEFT JOIN by_line USING (rid)),
failed AS (SELECT *, n_words < {r.min_words}
    OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed FROM every)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * lost_chars <= {r.max_lost_percent} * word_chars AS kept,
    lost_chars, nav_lines, noise_lines, boilerplate_lines, fragment_lines FROM failed
"""


def url_rules_sql() -> str:
    m = url_rules.Mining()
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_rules.LIST_RULES)
    return rf"""
WITH RECURSIVE p AS (SELECT row_number() OVER () AS uid, page_id, url, coalesce(url, '') AS u FROM pages),
h AS (SELECT uid, page_id, url, u,
    translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM p),
parts AS (SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels,
    regexp_extract(u, '(?s)^[^#?]*\?([^#]*)', 1) AS query,
    regexp_extract(path, '\.([A-Za-z0-9]+)$', 1) AS ext FROM h),
lists AS (SELECT *, CASE WHEN host = '' THEN [] ELSE list_distinct(
    CASE WHEN len(labels) >= 2
      THEN [('d:' || array_to_string(labels[len(labels) - k + 1:], '.'))
            FOR k IN range(2, len(labels) + 1)]
      ELSE [('d:' || x) FOR x IN labels] END
    || CASE WHEN len(labels) >= 1 THEN ['h:' || labels[1]] ELSE [] END
    || [('p:' || x) FOR x IN string_split(path, '/') IF x <> '']
    || CASE WHEN ext <> '' THEN ['x:' || ext] ELSE [] END
    || [('q:' || string_split(x, '=')[1]) FOR x IN string_split(query, '&') IF x <> '']
    || ['s:' || translate(string_split(u, '://')[1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz')]) END AS tokens FROM parts),
lab AS (SELECT doc_id AS page_id,
    max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS block
    FROM labels GROUP BY doc_id),
train AS (SELECT uid, tokens, block FROM lists JOIN lab USING (page_id) WHERE len(tokens) > 0),
tok AS (SELECT uid, block, unnest(tokens) AS token FROM train),
seen AS (SELECT token, list(uid ORDER BY uid) AS cover, sum(block) AS blocked FROM tok
    GROUP BY token HAVING sum(block) >= {m.min_pages}),
cls AS MATERIALIZED (SELECT cover, min(token) AS cls, list(token) AS members,
    any_value(blocked) / len(cover) AS confidence FROM seen GROUP BY cover),
bad AS MATERIALIZED (SELECT list(uid) AS uids FROM train WHERE block = 1),
grown AS (SELECT [cls] AS items, cls AS last, cover, confidence FROM cls
    UNION ALL SELECT items, last, cover, blocked / len(cover) FROM (
        SELECT *, len(list_intersect(cover, (SELECT uids FROM bad))) AS blocked FROM (
            SELECT list_append(g.items, c.cls) AS items, c.cls AS last,
                list_intersect(g.cover, c.cover) AS cover
            FROM grown g JOIN cls c ON c.cls > g.last AND c.confidence < {m.min_confidence}
            WHERE g.confidence < {m.min_confidence})) WHERE blocked >= {m.min_pages}),
found AS MATERIALIZED (SELECT items FROM grown WHERE confidence >= {m.min_confidence}),
mined AS (SELECT items FROM found f WHERE NOT EXISTS (SELECT 1 FROM found g
    WHERE len(g.items) < len(f.items)
      AND len(list_intersect(g.items, f.items)) = len(g.items))),
member AS (SELECT cls, unnest(members) AS token FROM cls),
held AS (SELECT uid, list(DISTINCT cls) AS held FROM (SELECT uid, unnest(tokens) AS token FROM lists)
    JOIN member USING (token) GROUP BY uid),
hits AS (SELECT uid, count(*) AS n FROM held, mined
    WHERE len(list_intersect(held, items)) = len(items) GROUP BY uid),
listed AS (SELECT uid, verdict, h || p AS rule,
    row_number() OVER (PARTITION BY uid ORDER BY length(h || p) DESC) AS k
    FROM lists, (VALUES {rules}) AS r(verdict, h, p)
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule,
    coalesce(verdict, CASE WHEN n > 0 THEN 'block' ELSE 'allow' END) AS verdict,
    coalesce(n, 0) AS n_mined
FROM lists LEFT JOIN hits USING (uid) LEFT JOIN (SELECT * FROM listed WHERE k = 1) USING (uid)
"""


MIX_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_PATTERN}'))
    AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT AS h
    FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
p AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place,
    3.0::DOUBLE * source_size AS cap FROM s),
w AS (SELECT *, list_extract([5.0, 2.0, 1.0]::DOUBLE[], place % 3 + 1) AS weight FROM p),
f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, place
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped_before,
    sum(weight) OVER (ORDER BY cap / weight, place
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left,
    (sum(source_size) OVER ())::DOUBLE AS all_words FROM w),
l AS (SELECT *, (all_words - capped_before) / weight_left AS level FROM f),
o AS (SELECT *, first(CASE WHEN level <= cap / weight THEN level END IGNORE NULLS) OVER
    (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_level
    FROM l),
t AS (SELECT source, source_size,
    CASE WHEN open_level IS NULL THEN cap ELSE least(cap, open_level * weight) END AS target
    FROM o),
b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END
    AS whole FROM t),
g AS (SELECT source, h, sum(size) AS words FROM d WHERE size > 0 GROUP BY source, h),
r AS (SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
c AS (SELECT r.source, min(r.h) AS h FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
    WHERE target - whole * source_size > 0 AND upto >= target - whole * source_size
    GROUP BY r.source),
cut AS (SELECT c.source, c.h + CASE WHEN target - whole * source_size - (upto - words)
      > words / 2 THEN 1 ELSE 0 END AS cut
    FROM c JOIN r ON c.source IS NOT DISTINCT FROM r.source AND c.h = r.h
    JOIN b ON c.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size::BIGINT AS size, b.source_size, b.target,
    (d.size * (whole + CASE WHEN d.h < coalesce(cut, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""

NEAR_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_PATTERN}') AS ws
    FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS sh FROM w),
n AS (SELECT w.doc_id, count(sh) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
common_sh AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common_sh JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * c >= 85 * (na.n + nb.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS node FROM n UNION
    SELECT reach.doc_id, e.b FROM reach JOIN both_ways e ON e.a = reach.node)
SELECT n.doc_id, n.n AS n_shingles, min(node) AS component_id, n.doc_id = min(node) AS kept
FROM n JOIN reach USING (doc_id) GROUP BY n.doc_id, n.n
"""

VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e
    FROM embeddings),
ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT x.rid AS a, y.rid AS b, x.vec_id AS a_id, y.vec_id AS b_id
    FROM ok x JOIN ok y ON x.rid <> y.rid AND len(x.e) = len(y.e)
    AND list_cosine_similarity(x.e, y.e) >= 0.9),
reach AS (SELECT rid, rid AS node FROM v UNION
    SELECT reach.rid, l.b FROM reach JOIN links l ON l.a = reach.node),
comp AS (SELECT reach.rid, min(v.vec_id) AS component_id
    FROM reach JOIN v ON v.rid = reach.node GROUP BY reach.rid),
n AS (SELECT a AS rid, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id,
    vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN comp USING (rid) LEFT JOIN n USING (rid)
"""

_BASE32 = " || ".join(
    f"translate(to_base(('0x' || substr(hex, {i}, 10))::BIGINT, 32, 8), "
    "'0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')"
    for i in (1, 11, 21, 31))
WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS largest FROM d),
r AS (SELECT *, largest IS NOT NULL AND page_id IS DISTINCT FROM largest AS again FROM g)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN again THEN largest END AS refers_to FROM r
"""

FIM_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT doc_id, t, u, len(u)::BIGINT AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1,
    ('0x' || substr(x, 9, 8))::BIGINT AS h2, ('0x' || substr(x, 17, 8))::BIGINT AS h3,
    ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS p,
    coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM p
"""

# crc32 byte by byte over a table made from its polynomial; letters have one byte or two
SPELLING_SQL = """
WITH RECURSIVE t AS (SELECT [list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1
      THEN xor(3988292384, c >> 1) ELSE c >> 1 END, x) FOR x IN range(0, 256)] AS crc),
d AS (SELECT row_number() OVER () AS rid, coalesce(doc_id::VARCHAR, '') || ':' AS head,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]{5,}')) AS run FROM documents),
r AS (SELECT rid, head, run, count(*) AS n FROM d GROUP BY rid, head, run),
b AS (SELECT run, n, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
    ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END FOR c IN string_split(head || run, '')]) AS bytes
    FROM r),
h AS (SELECT run, n, xor(list_reduce(bytes, lambda c, x: xor(c >> 8,
    list_extract(crc, (xor(c, x) & 255) + 1)), 4294967295), 4294967295) AS h FROM b, t),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 97 = 0
      THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
      FROM h) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
p AS (SELECT word, substr(word, 1, i) || '*' || substr(word, i + 2) AS pattern,
    substr(word, 1, i) || substr(word, i + 2) AS less
    FROM (SELECT word, unnest(range(0, length(word))) AS i FROM w)),
near AS MATERIALIZED (SELECT a.word, b.word AS other FROM p a JOIN p b USING (pattern)
      WHERE a.word <> b.word
    UNION SELECT p.word, w.word FROM p JOIN w ON w.word = p.less
    UNION SELECT w.word, p.word FROM p JOIN w ON w.word = p.less),
best AS (SELECT near.word, count(*) AS n_near, arg_max(other, w.n) AS any_best, max(w.n) AS best_n
    FROM near JOIN w ON w.word = near.other GROUP BY near.word),
first AS (SELECT near.word, min(other) AS other FROM near JOIN w ON w.word = near.other
    JOIN best ON best.word = near.word AND best.best_n = w.n GROUP BY near.word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN best_n >= 2 * w.n THEN other END AS form,
    CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
    FROM w LEFT JOIN best USING (word) LEFT JOIN first USING (word)),
chain AS (SELECT word, word AS place FROM f
    UNION SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.place
    WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.place AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word JOIN f e ON e.word = chain.place AND e.form IS NULL
"""

SQL = {
    "op1_line_rules": line_rules_sql(),
    "op2_url_rules": url_rules_sql(),
    "op4_warc": WARC_SQL,
    "op6_mixing": MIX_SQL,
    "op8_near_duplicates": NEAR_SQL,
    "op10_metric_join": VECTOR_SQL,
    "op11_fill_in_middle": FIM_SQL,
    "op12_spelling_variants": SPELLING_SQL,
}
