"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
wt AS (
  SELECT *, (CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
             WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END)::DOUBLE AS w,
         (source_size * 3)::DOUBLE AS cap
  FROM src),
lv AS (
  SELECT *, ((SELECT sum(source_size) FROM src)
     - coalesce(sum(cap) OVER (ORDER BY cap / w, encode(source) NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(w) OVER (ORDER BY cap / w, encode(source) NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl
  FROM wt),
tg AS (
  SELECT source, source_size, least(cap, w * (SELECT max(lvl) FROM lv)) AS target FROM lv),
bd AS (
  SELECT *, least(round(target)::BIGINT, source_size * 3) AS budget FROM tg),
ep AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS e FROM bd),
run AS (
  SELECT d.doc_id, d.source, d.size, ep.source_size, ep.target, ep.e,
         ep.budget - ep.e * ep.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN ep ON d.source IS NOT DISTINCT FROM ep.source)
"""

_DOC_COLUMNS = "doc_id, source, size, source_size, target"

OP7 = _MIX + f"""
SELECT {_DOC_COLUMNS}, (e * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM run"""

OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         {_WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
w AS (
  SELECT r, unnest(range(1, len(ws) - 3)) AS i, ws FROM d WHERE len(ws) >= 5),
g AS (SELECT r, i, list_slice(ws, i, i + 4) AS gram FROM w),
dup AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g),
cov AS (SELECT DISTINCT r, i + j AS p FROM dup, (SELECT unnest(range(0, 5)) AS j) WHERE c > 1),
rep AS (SELECT r, count(*) AS n FROM cov GROUP BY r),
m AS (
  SELECT d.r, doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (r)),
f AS (
  SELECT *, (n_words < 10 OR n_repeat_words * 100 > n_words * 20) AS base_failed,
         (n_words < 10 OR n_repeat_words * 100 > n_words * 20
          OR n_symbols > n_words * 0.5 OR n_dup_lines > 3) AS rules_failed
  FROM m),
h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(rules_failed::INT)::DOUBLE AS f FROM f GROUP BY source),
p AS (
  SELECT sum(f) / sum(n) AS mean,
         greatest(sum(n * (f / n) * (f / n)) / sum(n) - (sum(f) / sum(n)) ** 2, 0) AS spread
  FROM h),
s AS (
  SELECT mean, CASE WHEN spread > 1e-12
     THEN least(greatest(mean * (1 - mean) / spread - 1, 1), 1000) ELSE 1000 END AS st FROM p),
v AS (SELECT source, round((f + mean * st) / (n + st), 6) AS host_rate FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND host_rate <= 0.6) AS kept, rules_failed, host_rate
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source"""

_FLOOR_MEAN = "((s - ((s % n) + n) % n) // n)"


def _lloyd(rounds: int, entries: int, parts: int = 4) -> str:
    """Product codes by brute force: every part against every entry."""
    dist = ("list_inner_product(x, x) - 2 * list_inner_product(x, c) "
            "+ list_inner_product(c, c)")
    sql = f"""
WITH v AS (
  SELECT vec_id, label, len(embedding) // {parts} AS w,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v,
         row_number() OVER (ORDER BY vec_id NULLS LAST) AS r
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT r, q AS part, w, list_slice(v, q * w + 1, (q + 1) * w) AS x
  FROM v, (SELECT unnest(range({parts})) AS q)),
b0 AS (SELECT part, r - 1 AS entry, x AS c FROM p WHERE r <= {entries})"""
    for k in range(rounds + 1):
        sql += f""",
a{k} AS (
  SELECT r, part, min(struct_pack(d := {dist}, e := entry)) AS m
  FROM p JOIN b{k} USING (part) GROUP BY r, part)"""
        if k < rounds:
            sql += f""",
s{k} AS (
  SELECT part, m.e AS entry, i, sum(x[i]::BIGINT)::HUGEINT AS s, count(*) AS n
  FROM a{k} JOIN p USING (r, part), (SELECT unnest(range(1, w + 1)) AS i FROM (SELECT max(w) AS w FROM p))
  GROUP BY ALL),
b{k + 1} AS (
  SELECT part, entry, coalesce(new, c) AS c
  FROM b{k} LEFT JOIN (SELECT part, entry, list({_FLOOR_MEAN}::DOUBLE ORDER BY i) AS new
                       FROM s{k} GROUP BY part, entry) USING (part, entry))"""
    return sql + f""",
o AS (
  SELECT r, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' ORDER BY part) AS code,
         sum(m.d)::BIGINT AS error
  FROM a{rounds} GROUP BY r),
h AS (
  SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(c) AS y, unnest(range(len(c))) AS i FROM b{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       codebooks_sha256
FROM v JOIN o USING (r), h"""


OP11 = _lloyd(rounds=4, entries=256)

# crc32 of a short text, bit by bit (DuckDB has none)
_CRC32 = """(xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
  range(1, length({0}) + 1),
  lambda i: list_prepend(ascii({0}[i])::BIGINT, list_transform(range(8), lambda j: -1::BIGINT))))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b)
                    WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END),
  4294967295::BIGINT))"""

OP13 = rf"""
WITH own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hd AS (
  SELECT conv_id, t, conv_id - conv_id % 20 AS base,
         ({_CRC32.format("(conv_id::VARCHAR)")} % 4)::BIGINT AS h FROM own),
built AS (
  SELECT hd.conv_id, list_concat(coalesce(list_slice(b.t, 1, h), []), list_slice(hd.t, h + 1, len(hd.t))) AS t
  FROM hd LEFT JOIN own b ON hd.base = b.conv_id),
m AS (
  SELECT conv_id, d, list_slice(t, 1, d) AS path, d = len(t) AS ends
  FROM built, LATERAL (SELECT unnest(range(0, len(t) + 1)) AS d)),
n AS (
  SELECT path, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY path),
k AS (
  SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n_children
  FROM n WHERE depth > 0 GROUP BY 1),
v AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE
           (n_convs - 1) * len(regexp_extract_all(path[depth].x, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN k USING (path)),
sub AS (
  SELECT m.path, sum((v.n_children = 0)::INT) AS n_leaves, sum(v.saved) AS saved_tokens
  FROM v JOIN m ON m.conv_id = v.conv_id AND m.d <= v.depth GROUP BY m.path)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
       v.n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN sub USING (path)
LEFT JOIN n p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.path = list_slice(v.path, 1, v.depth - 1)"""

ORACLE = {"op5_host_rules": OP5, "op7_source_mix": OP7, "op11_vector_codes": OP11,
          "op13_prefix_trie": OP13}
