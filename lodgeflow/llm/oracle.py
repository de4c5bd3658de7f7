"""DuckDB SQL for the queries of the subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 bit by bit: each byte is put in at the first of its eight steps
_IMPORTANCE = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bench_words AS (
  SELECT regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
doc_features AS (
  SELECT doc_id, unnest(w) AS feature FROM doc_words
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM doc_words),
bench_features AS (
  SELECT unnest(w) AS feature FROM bench_words
  UNION ALL
  SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM bench_words),
digits AS (
  SELECT feature, hex(encode(feature)) AS h
  FROM (SELECT feature FROM doc_features UNION SELECT feature FROM bench_features)),
steps AS (
  SELECT feature, flatten(list_transform(range(1, length(h), 2), lambda i: [
    CAST((strpos('0123456789ABCDEF', h[i]) - 1) * 16 + strpos('0123456789ABCDEF', h[i + 1]) - 1 AS BIGINT),
    0, 0, 0, 0, 0, 0, 0])) AS s
  FROM digits),
hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), s),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 10000 AS bucket
  FROM steps),
doc_buckets AS (SELECT doc_id, bucket, count(*) AS n FROM doc_features JOIN hashed USING (feature) GROUP BY ALL),
corpus AS (SELECT bucket, sum(n) AS s FROM doc_buckets GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM bench_features JOIN hashed USING (feature) GROUP BY bucket),
totals AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM corpus) AS all_s, (SELECT coalesce(sum(t), 0) FROM target) AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + 10000))::DOUBLE
    / ((s + 1) * (all_t + 10000))::DOUBLE))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (bucket) CROSS JOIN totals),
weights AS (
  SELECT doc_id, sum(n) AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM doc_buckets JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features,
    coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || sha256('7:' || d.doc_id)[1:8])::BIGINT AS h
  FROM doc_words d LEFT JOIN weights USING (doc_id)),
final AS (
  SELECT doc_id, n_words, n_features, weight,
    weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM scored),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
  FROM final WHERE n_words >= 20)
SELECT f.doc_id, f.n_features, f.weight, f.score,
  CASE WHEN place <= 25 * able // 100 THEN place END AS rank
FROM final f LEFT JOIN ranked USING (doc_id)
"""

_LINE_DEDUP = rf"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
  SELECT doc_id, line, place, {_LOWER.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")}
    AS key
  FROM each),
common AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, line, place, coalesce(doc_id <> last, FALSE) AS dropped FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_FILTER_AUDIT = r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY text) AS first_id
  FROM texts),
facts AS (
  SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d, doc_id > first_id AS e,
    coalesce(quality = 1, FALSE) AS good, coalesce(toxic = 1, FALSE) AS toxic
  FROM words LEFT JOIN labels USING (doc_id)),
masks AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
    count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE facts.toxic) AS toxic
  FROM facts GROUP BY ALL),
letters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT l1.f || l2.f || l3.f || l4.f || l5.f AS filter_order
  FROM letters l1 JOIN letters l2 ON l2.f <> l1.f JOIN letters l3 ON l3.f NOT IN (l1.f, l2.f)
  JOIN letters l4 ON l4.f NOT IN (l1.f, l2.f, l3.f) JOIN letters l5 ON l5.f NOT IN (l1.f, l2.f, l3.f, l4.f)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, l.f, l.bit,
    coalesce((SELECT sum(p.bit) FROM letters p WHERE strpos(filter_order, p.f) < step), 0)::INT AS earlier
  FROM orders CROSS JOIN range(1, 6) r(step) JOIN letters l ON l.f = filter_order[step]),
counted AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (WHERE mask & (earlier | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE mask & earlier <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE mask & earlier = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM masks CROSS JOIN steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""

# all pairs of vectors; every vector reaches its group by links
_EGO_JOIN = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda e: e::DOUBLE) AS x FROM embeddings),
able AS (
  SELECT vec_id, x FROM vectors
  WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM vectors
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS vec_id, coalesce(max(n), 0)::BIGINT AS n_links, min(r.b) AS component_id, min(r.b) = r.a AS kept
FROM reached r LEFT JOIN degrees d ON d.a = r.a GROUP BY r.a
"""

# words hold no blanks, so shingles joined by one are equal only if their words are
_NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b
    ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id
FROM sets JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) ON a = doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op4_ego_join": _EGO_JOIN,
    "op8_ngram_join": _NGRAM_JOIN,
    "op11_importance_resampling": _IMPORTANCE,
    "op12_line_dedup": _LINE_DEDUP,
    "op13_filter_audit": _FILTER_AUDIT,
}
