"""DuckDB SQL of the queries that SQL can express, written independently of the Spark code."""

WORD = r"[^\x20\x09-\x0D]+"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 3))::INT AS slice
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
-- The level is the largest one at which capped shares do not pass the budget; it lies between two neighbouring caps.
v AS (
  SELECT a.source, a.source_size, a.w,
         (SELECT sum(source_size) FROM s) - coalesce(sum(3 * b.source_size) FILTER (b.source_size * a.w < a.source_size * b.w), 0) AS rest,
         sum(b.w) FILTER (b.source_size * a.w >= a.source_size * b.w) AS open
  FROM s a CROSS JOIN s b GROUP BY a.source, a.source_size, a.w),
l AS (SELECT rest, open FROM v WHERE rest * w < 3 * source_size * open ORDER BY open DESC LIMIT 1),
t AS (
  SELECT v.source, v.source_size,
         CASE WHEN v.rest * v.w >= 3 * v.source_size * v.open THEN (3 * v.source_size)::DOUBLE ELSE l.rest::DOUBLE * v.w / l.open END AS target
  FROM v LEFT JOIN l ON true),
r AS (
  SELECT *, least(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END), 3)::INT AS whole FROM t),
x AS (
  SELECT source, slice, size, sum(size) OVER (PARTITION BY source ORDER BY slice) AS upto
  FROM (SELECT source, slice, sum(size)::BIGINT AS size FROM d GROUP BY source, slice)),
c AS (
  SELECT r.source, r.source_size, r.target, r.whole,
         coalesce(max(x.slice) FILTER (x.size > 0 AND 2 * x.upto - x.size <= 2 * (r.target - r.whole * r.source_size)), -1) AS last_slice
  FROM r JOIN x ON x.source IS NOT DISTINCT FROM r.source GROUP BY ALL)
SELECT d.doc_id, d.size, c.source_size, c.target,
       (c.whole + CASE WHEN d.slice <= c.last_slice AND c.whole < 3 THEN 1 ELSE 0 END)::BIGINT AS copies,
       d.size * copies AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
"""

OP4 = rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
i AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS t
      FROM (SELECT r, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM i),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM w),
k AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l WHERE regexp_matches(line, '{WORD}') GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
         len(regexp_extract_all(text, '\p{{Lu}}'))::BIGINT AS n_upper, len(regexp_extract_all(text, '!'))::BIGINT AS n_exclamations,
         coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (r) LEFT JOIN k USING (r)),
f AS (
  SELECT *, coalesce(chars, 0)::BIGINT AS word_chars,
         (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
          + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
          + CASE WHEN coalesce(chars, 0) > 25 * n_words THEN 16 ELSE 0 END
          + CASE WHEN coalesce(chars, 0) < 2 * n_words THEN 32 ELSE 0 END
          + CASE WHEN 10 * n_upper > 3 * coalesce(chars, 0) THEN 64 ELSE 0 END
          + CASE WHEN 10 * n_exclamations > n_words THEN 128 ELSE 0 END)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_exclamations, fail_bits,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept
FROM f
"""

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP10 = rf"""
WITH b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({FOLD.format("coalesce(text, '')")}, '{ITEM_WORD}') AS ws
  FROM benchmark),
bw AS (
  SELECT item, least(13, len(ws)) AS width, ws, unnest(generate_series(1, len(ws) - least(13, len(ws)) + 1)) AS i FROM b WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item, width, ws[i:i + width - 1] AS g FROM bw),
widths AS (SELECT DISTINCT width FROM windows),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({FOLD.format("coalesce(text, '')")}, '{ITEM_WORD}') AS ws FROM documents),
dw AS (
  SELECT r, width, ws, unnest(generate_series(1, len(ws) - width + 1)) AS i FROM d, widths WHERE len(ws) >= width),
hits AS (SELECT dw.r, dw.i, dw.width, w.item FROM dw JOIN windows w ON w.width = dw.width AND w.g = dw.ws[dw.i:dw.i + dw.width - 1]),
n AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + width - 1)) AS p FROM hits) GROUP BY r),
it AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT r, item FROM hits WHERE item IS NOT NULL) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)
"""

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({FOLD.format("coalesce(text, '')")}, '{WORD}') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, 1))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, (SELECT min(y) FROM reach r WHERE r.x = w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
"""


def _nearest(entries: str) -> str:
    """Index and squared distance of every part's nearest entry; both fit one whole number, so ties go to the lower index."""
    apart = "list_sum(list_transform(range(1, len(p.a) + 1), lambda i: (p.a[i] - e.a[i]) * (p.a[i] - e.a[i])))::BIGINT"
    return f"""
SELECT vec_id, part, a, m % 64 AS entry, m // 64 AS apart
FROM (SELECT p.vec_id, p.part, any_value(p.a) AS a, min({apart} * 64 + e.entry) AS m
      FROM parts p JOIN {entries} e ON e.part = p.part GROUP BY p.vec_id, p.part)"""


def _means(entries: str, near: str) -> str:
    """Entries replaced by their parts' means, rounded down; unused ones stay."""
    return f"""
SELECT e.part, e.entry, coalesce(m.a, e.a) AS a
FROM {entries} e LEFT JOIN (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY place) AS a
  FROM (SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n
        FROM (SELECT part, entry, unnest(a) AS x, generate_subscripts(a, 1) AS place FROM {near}) GROUP BY ALL)
  GROUP BY part, entry) m ON m.part = e.part AND m.entry = e.entry"""


OP12 = f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS a FROM k, range(16) r(part)),
e0 AS MATERIALIZED (
  SELECT p.part, s.entry, p.a
  FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 64) s JOIN parts p ON p.vec_id = s.vec_id),
n0 AS MATERIALIZED ({_nearest("e0")}),
e1 AS MATERIALIZED ({_means("e0", "n0")}),
n1 AS MATERIALIZED ({_nearest("e1")}),
e2 AS MATERIALIZED ({_means("e1", "n1")}),
n2 AS MATERIALIZED ({_nearest("e2")}),
c AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error FROM n2 GROUP BY vec_id)
SELECT c.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(a, ','), ',' ORDER BY part, entry)) FROM e2) AS codebooks_sha256
FROM c JOIN k ON k.vec_id = c.vec_id
"""

#: CRC-32 of the decimal id, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
  lambda c, x: list_reduce([xor(c, x), 1, 2, 3, 4, 5, 6, 7, 8], lambda v, i: xor(v >> 1, 3988292384::BIGINT * (v & 1)))))"""

OP13 = rf"""
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o)),
r AS (
  SELECT c.conv_id, o.pos AS k, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.pos < c.h
  UNION ALL
  SELECT c.conv_id, o.pos + 4, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos >= c.h),
s AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(length(role) || ':' || role || text), '') OVER w AS key,
         len(regexp_extract_all(text, '{WORD}')) AS words
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
p AS MATERIALIZED (SELECT * FROM s UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS MATERIALIZED (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, left(key, 32 * (depth - 1)) AS above
  FROM p GROUP BY key, depth),
k AS MATERIALIZED (SELECT above AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above),
t AS (
  SELECT left(n.key, 32 * d) AS key, sum(CASE WHEN k.key IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM n LEFT JOIN k ON k.key = n.key, unnest(range(0, n.depth + 1)) u(d) GROUP BY 1),
e AS (
  SELECT key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, max_by(key, depth) AS key FROM p GROUP BY conv_id) GROUP BY key)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, t.n_leaves::BIGINT AS n_leaves,
       t.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN t ON t.key = n.key LEFT JOIN k ON k.key = n.key LEFT JOIN e ON e.key = n.key LEFT JOIN n a ON a.key = n.above AND n.depth > 0
"""

ORACLES = {
    "op1_ngram_join": OP1,
    "op2_mixing": OP2,
    "op4_rule_ledger": OP4,
    "op10_decontamination": OP10,
    "op12_vector_codes": OP12,
    "op13_conversation_trie": OP13,
}
