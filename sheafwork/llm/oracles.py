"""The queries of this subpackage as plain SQL for an independent engine, where SQL can express them."""

from __future__ import annotations

from . import hard_negatives, lexical, mixing, ngram_join, sharding, topk, url_filter

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"'[^\x20\x09-\x0D]+'"
_COUNT = f"len(regexp_extract_all(coalesce(text, ''), {_WORD}))"
_LOWERED = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORD})"
# crc32 of a short text, from its definition: a table of 256 entries, then byte by byte.
_CRC_TABLE = """
crc_table AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
  FROM (SELECT unnest(range(256)) AS i)))
"""


def _crc32_of(codes: str) -> str:
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({codes}, {step}, 4294967295::BIGINT), 4294967295)"


def _crc32(text: str) -> str:
    return _crc32_of(f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)")


_WEIGHT = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(mixing.WEIGHTS))
_HEX = mixing._DRAW_DIGITS

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_TRACKING = ", ".join(f"'{name}'" for name in url_filter.TRACKING)
_BLOCKED = ", ".join(f"'{word}'" for word in url_filter.BLOCKED_WORDS)
_LONGEST_FIRST = sorted(url_filter.RULES, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0])))
_RULED = " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{host}{path}'"
    for host, path, _ in _LONGEST_FIRST
)
_VERDICTS = " ".join(f"WHEN '{host}{path}' THEN '{says}'" for host, path, says in url_filter.RULES)

ORACLES: dict[str, str] = {
    "op2_norm_bucketed_topk": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= {topk.K}
""",
    "op5_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_LOWERED} AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= {ngram_join.WORDS} THEN list_distinct(list_transform(
           range(1, len(w) - {ngram_join.WORDS} + 2), lambda i: array_to_string(w[i:i + {ngram_join.WORDS - 1}], ' ')))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM w
),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {ngram_join.PERCENT} * (a.n + b.n - count(*))
),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(s.s) AS n_shingles, coalesce(least(s.doc_id, m.m), s.doc_id) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) m ON s.doc_id = m.a
""",
    "op8_source_mixing": f"""
WITH d AS (SELECT doc_id, source, {_COUNT} AS size FROM documents),
p AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} {_WEIGHT} END AS weight
  FROM d GROUP BY source
),
o AS (
  SELECT *, source_size * {mixing.LIMIT} AS most, sum(source_size) OVER () * {mixing.SHARE} AS budget,
         row_number() OVER (ORDER BY source_size * {mixing.LIMIT} / weight, source NULLS LAST) AS turn
  FROM p
),
l AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM o
),
t AS (
  SELECT source, source_size,
         coalesce(least(most, weight * (SELECT arg_min(level, turn) FROM l WHERE level * weight < most)), most) AS target
  FROM l
),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, {mixing.LIMIT}) ELSE 0.0 END AS rate FROM t),
c AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target,
         (floor(rate) + CASE WHEN ('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, {_HEX}))::BIGINT
                                  / {float(16**_HEX)} < rate - floor(rate) THEN 1 ELSE 0 END)::INT AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, source, size, source_size, target, size * copies AS taken, copies FROM c
""",
    "op10_kneser_ney": f"""
WITH {_CRC_TABLE},
d AS (
  SELECT doc_id, coalesce({_crc32("doc_id::VARCHAR")} % 5 = 1, false) AS held_out, list_append({_LOWERED}, ' end') AS w
  FROM documents, crc_table
),
k AS (SELECT doc_id, held_out, unnest(w) AS w, unnest(list_prepend(' start', w[:-2])) AS v FROM d),
u AS (SELECT w, count(*) AS c FROM k WHERE NOT held_out GROUP BY w),
z AS (SELECT sum(c) AS n, count(*) AS v FROM u),
b AS (SELECT v, w, count(*) AS c FROM k WHERE NOT held_out GROUP BY v, w),
a AS (SELECT w, count(*) AS a FROM b GROUP BY w),
x AS (SELECT v, sum(c) AS c, count(*) FILTER (c = 1) AS o, count(*) FILTER (c = 2) AS t, count(*) FILTER (c > 2) AS m FROM b GROUP BY v),
n AS (
  SELECT 1 AS level, count(*) FILTER (c = 1) AS n1, count(*) FILTER (c = 2) AS n2, count(*) FILTER (c = 3) AS n3,
         count(*) FILTER (c = 4) AS n4 FROM b
  UNION ALL
  SELECT 0, count(*) FILTER (a = 1), count(*) FILTER (a = 2), count(*) FILTER (a = 3), count(*) FILTER (a = 4) FROM a
),
f AS (
  SELECT level,
         CASE WHEN least(n1, n2, n3) > 0 THEN least(greatest(1 - 2 * y * n2 / n1, 0), 1) ELSE 0.5 END AS d1,
         CASE WHEN least(n1, n2, n3) > 0 THEN least(greatest(2 - 3 * y * n3 / n2, 0), 2) ELSE 1.0 END AS d2,
         CASE WHEN least(n1, n2, n3) > 0 THEN least(greatest(3 - 4 * y * n4 / n3, 0), 3) ELSE 1.5 END AS d3
  FROM (SELECT *, n1 / (n1 + 2 * n2) AS y FROM n)
),
hi AS (SELECT * FROM f WHERE level = 1), lo AS (SELECT * FROM f WHERE level = 0),
g AS (
  SELECT (sum(CASE WHEN a = 1 THEN lo.d1 WHEN a = 2 THEN lo.d2 ELSE lo.d3 END) / sum(a)) AS g0, sum(a) AS total FROM a, lo
),
p AS (
  SELECT k.doc_id, k.held_out, coalesce(u.c, 0) AS c, z.n, z.v,
         log10(coalesce(greatest(coalesce(b.c, 0) - CASE coalesce(b.c, 0) WHEN 0 THEN 0 WHEN 1 THEN hi.d1 WHEN 2 THEN hi.d2 ELSE hi.d3 END, 0) / x.c, 0)
           + coalesce((hi.d1 * x.o + hi.d2 * x.t + hi.d3 * x.m) / x.c, 1)
           * (greatest(coalesce(a.a, 0) - CASE coalesce(a.a, 0) WHEN 0 THEN 0 WHEN 1 THEN lo.d1 WHEN 2 THEN lo.d2 ELSE lo.d3 END, 0) / g.total
              + g.g0 / (z.v + 1))) AS lp
  FROM k LEFT JOIN u ON k.w = u.w LEFT JOIN b ON k.v = b.v AND k.w = b.w LEFT JOIN a ON k.w = a.w LEFT JOIN x ON k.v = x.v,
       z, hi, lo, g
)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (c > 0) AS n_known, any_value(n)::BIGINT AS train_tokens,
       round(sum(log10((c + 0.5) / (n + 0.5 * (v + 1)))), 6) AS base_score, round(sum(lp), 6) AS score
FROM p GROUP BY doc_id, held_out
""",
    "op9_stratified_shards": f"""
WITH {_CRC_TABLE},
d AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
         {_crc32_of("list_transform(range(1, 2 * strlen(coalesce(text, '')), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)")} AS text_crc32,
         md5('{sharding.SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS shuffle
  FROM (SELECT *, hex(encode(coalesce(text, ''))) AS h FROM documents), crc_table
),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY shuffle, doc_id NULLS FIRST, text_crc32, size) - 0.5::DOUBLE)
            / count(*) OVER (PARTITION BY source) AS fraction,
         count(*) OVER () AS n
  FROM d
),
p AS (SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST) - 1 AS place FROM r),
c AS (SELECT *, place * {sharding.SHARDS} // n AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard,
       place - (shard * n + {sharding.SHARDS - 1}) // {sharding.SHARDS} AS slot, NULL::INT AS grown_shard, source
FROM c
""",
    "op11_term_pipeline_search": f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents WHERE doc_id IS NOT NULL),
z AS (SELECT count(*) AS n, sum(len(t)) AS l FROM d WHERE len(t) > 0),
f AS (SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(z.n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, z GROUP BY term),
i AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE item_id IS NOT NULL),
s AS (
  SELECT item_id, doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * f.n * z.n) // z.l))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN f USING (term), z GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {lexical.K}
""",
    "op12_hard_negatives": f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES}
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {hard_negatives.LEAST_PERCENT} * positive_score <= 100 * score
  AND 100 * score <= {hard_negatives.MOST_PERCENT} * positive_score
QUALIFY rank <= {hard_negatives.NEGATIVES}
""",
    "op13_url_filter": f"""
WITH u AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         list_sort(list_filter(string_split(coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\\?([^#]*)', 1), ''), '&'),
           lambda p: p <> '' AND NOT starts_with(p, 'utm_') AND NOT list_contains([{_TRACKING}], string_split(p, '=')[1]))) AS q
  FROM pages
),
k AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '') || regexp_replace(path, '/+$', '')
                 || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS key
  FROM u
),
listed AS (SELECT DISTINCT key FROM k WHERE key IS NOT NULL AND list_has_any(regexp_split_to_array(host, '[.-]'), [{_BLOCKED}])),
r AS (
  SELECT k.*, listed.key IS NOT NULL AS listed, CASE {_RULED} END AS rule FROM k LEFT JOIN listed ON k.key = listed.key
)
SELECT page_id, host, path, rule, listed,
       CASE rule {_VERDICTS} ELSE CASE WHEN listed THEN 'block' ELSE 'allow' END END AS verdict
FROM r
""",
}
