"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len({WORDS}), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w,
             2.0 * source_size AS cap FROM s),
b AS (SELECT 1.5 * sum(source_size) AS budget FROM s),
-- sources in the order in which they reach their cap
o AS (SELECT *, sum(cap) OVER q - cap AS capped_before, sum(w) OVER q2 AS w_left
      FROM r WINDOW q AS (ORDER BY cap / w, source NULLS LAST),
                    q2 AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lv AS (SELECT min_by((budget - capped_before) / w_left, cap / w) AS level
       FROM o, b WHERE (budget - capped_before) / w_left * w <= cap),
t AS (SELECT source, source_size, least(coalesce(level, 1e300) * w, cap) AS target FROM r, lv),
f AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS full_ FROM t),
x AS (SELECT d.*, source_size, target, full_, target - full_ * source_size AS rest
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source),
g AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
c AS (SELECT source, h, n, sum(n) OVER (PARTITION BY source ORDER BY h) AS upto FROM g)
SELECT x.doc_id, x.size, x.source_size, x.target,
       (x.size * (full_ + CASE WHEN rest > 0 AND (upto <= rest OR (upto - n < rest AND upto - rest <= rest - (upto - n)))
                               THEN 1 ELSE 0 END))::BIGINT AS taken
FROM x JOIN c ON x.source IS NOT DISTINCT FROM c.source AND x.h = c.h
"""

OP5 = rf"""
WITH t AS (
  SELECT doc_id, source, coalesce({WORDS}, []::VARCHAR[]) AS ws, coalesce(text, '') AS text,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls,
         row_number() OVER () AS rid
  FROM documents),
w AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS i, ws FROM t WHERE len(ws) >= 8),
k AS (SELECT rid, i, md5(array_to_string(ws[i:i + 7], chr(31))) AS k FROM w),
r AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, k) AS c FROM k) WHERE c > 1),
n AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
      FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM r) GROUP BY rid),
b AS (SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n.n, 0)::BIGINT AS n_repeat_words
      FROM t LEFT JOIN n USING (rid)),
j AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM b),
h AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS k FROM j GROUP BY source),
a AS (SELECT count(*) AS m, sum(n) AS n, sum(k) AS k, sum(n * n) AS nn, sum(k * k / n) AS kk FROM h),
p AS (SELECT k / n AS mean, k / n * (1 - k / n) AS noise,
             (kk - k * k / n - (m - 1) * (k / n * (1 - k / n))) / greatest(n - nn / n, 1.0) AS between_ FROM a),
q AS (SELECT mean, CASE WHEN between_ > 0 THEN least(greatest(noise / between_ - 1, 1.0), 1e4) ELSE 1e4 END AS st FROM p),
v AS (SELECT source, (k + mean * st) / (n + st) <= 0.5 AS ok FROM h, q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
"""

# every window of lines with 50 words or more is compared, none is sampled
OP10 = r"""
WITH l AS (
  SELECT doc_id, pos, line, n, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) - n AS b
  FROM (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line,
               len(regexp_extract_all(unnest(ls), '[^\x20\x09-\x0D]+')) AS n
        FROM (SELECT DISTINCT doc_id, string_split(text, chr(10)) AS ls FROM documents))
  WHERE n > 0),
w AS (
  SELECT doc_id, pos, 0 AS kind, md5(string_agg(line, chr(10)) OVER f) AS k, sum(n) OVER f AS s, b AS from_,
         max(b + n) OVER f AS to_ FROM l
  WINDOW f AS (PARTITION BY doc_id ORDER BY b RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, pos, 1, md5(string_agg(line, chr(10)) OVER f), sum(n) OVER f, min(b) OVER f, b + n FROM l
  WINDOW f AS (PARTITION BY doc_id ORDER BY b + n RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
later AS (
  SELECT doc_id, from_, to_ FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, k ORDER BY doc_id NULLS FIRST, pos) AS r FROM w WHERE s >= 50)
  WHERE r > 1),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM l JOIN later x
         ON l.doc_id = x.doc_id AND l.b >= x.from_ AND l.b < x.to_),
g AS (SELECT doc_id, list(pos) AS p FROM gone GROUP BY doc_id)
SELECT d.doc_id,
       CASE WHEN p IS NULL THEN text ELSE coalesce(array_to_string(
         list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(p, i - 1)), chr(10)), '') END AS text,
       coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(p), 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""

OP8 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(m, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN c ON e.vec_id = c.a
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS x
  FROM documents),
h AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2,
         ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid,
         coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

ORACLE = {"op13_fill_in_middle": OP13, "op8_embedding_dedup": OP8, "op1_mix_sources": OP1, "op5_quality_rules": OP5, "op10_line_dedup": OP10}
