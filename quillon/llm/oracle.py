"""DuckDB SQL for the queries that SQL can express."""

OP10 = r"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
t AS (SELECT doc_id, text, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
tri AS (SELECT doc_id, i, ws[i:i+2] AS g FROM t),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w),
dl AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT w.doc_id, source, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN dl USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_words OR word_chars > 15 * n_words AS failed FROM b),
h AS (SELECT source, count(*) AS n, sum(failed::BIGINT) AS k FROM f GROUP BY source),
s AS (SELECT avg(k / n) AS mean, sum((k / n) * (k / n)) / count(*) - avg(k / n) * avg(k / n) AS var FROM h),
p AS (SELECT mean, CASE WHEN var > 1e-9 THEN greatest(1.0, mean * (1 - mean) / var - 1) ELSE 1.0 END AS strength FROM s),
r AS (SELECT source, round((k + mean * strength) / (n + strength), 6) AS host_rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_rate, NOT base_failed AND host_rate <= 0.5 AS kept
FROM f JOIN r ON f.source IS NOT DISTINCT FROM r.source
"""

OP9 = r'''
WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM documents),
l1 AS (SELECT doc_id, line, t, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM l0),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS k, sum(w) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM l1 WHERE w > 0),
f AS (SELECT a.doc_id, a.k AS k, min(b.k) AS z FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.k >= a.k AND b.k < a.k + 50 AND b.upto - a.upto + a.w >= 50 GROUP BY 1, 2),
r AS (SELECT a.doc_id, max(b.k) AS k, a.k AS z FROM l a JOIN l b ON a.doc_id = b.doc_id AND b.k <= a.k AND b.k > a.k - 50 AND a.upto - b.upto + b.w >= 50 GROUP BY a.doc_id, a.k),
u AS (SELECT * FROM f UNION SELECT * FROM r),
g AS (SELECT u.doc_id, u.k, u.z, min(l.line) AS s, max(l.line) AS e, string_agg(l.t, chr(10) ORDER BY l.k) AS run FROM u JOIN l ON u.doc_id = l.doc_id AND l.k BETWEEN u.k AND u.z GROUP BY 1, 2, 3),
n AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS i FROM g),
d AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS line FROM n WHERE i > 1),
m AS (SELECT l0.doc_id, l0.line, l0.t, d.line IS NOT NULL AS gone, d.line IS NOT NULL AND NOT coalesce(lag(d.line IS NOT NULL) OVER (PARTITION BY l0.doc_id ORDER BY l0.line), false) AS starts
  FROM l0 LEFT JOIN d ON l0.doc_id = d.doc_id AND l0.line = d.line)
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(gone::INT)::BIGINT AS n_deleted, sum(starts::INT)::BIGINT AS n_runs,
  sha256(coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
'''

OP1 = r'''
WITH RECURSIVE t AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
rows_ AS (SELECT doc_id, source, sum(tokens)::BIGINT AS tokens FROM t GROUP BY doc_id, source, text),
src AS (SELECT source, sum(tokens)::BIGINT AS tokens, count(*) AS docs FROM rows_ GROUP BY source),
tot AS (SELECT sum(tokens)::BIGINT AS total, max(tokens)::BIGINT AS top, list(tokens::DOUBLE) AS ts FROM src WHERE tokens > 0),
bis AS (SELECT -1::BIGINT AS lo, (1::BIGINT << 30) AS hi UNION ALL
  SELECT CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (SELECT lo, hi, mid,
    list_max(list_transform(ts, lambda x: pow(x / total, mid / (1::BIGINT << 30)) / x)) * top / pow(top / total, mid / (1::BIGINT << 30)) <= 2.0 AS ok
    FROM (SELECT *, (lo + hi) // 2 AS mid FROM bis WHERE hi - lo > 1), tot)),
al AS (SELECT min(hi) / (1::BIGINT << 30) AS a FROM bis),
z AS (SELECT a, sum(pow(tokens / total, a)) AS z, any_value(top * 1.0) AS top, any_value(total) AS total FROM src, tot, al WHERE tokens > 0 GROUP BY a),
wt AS (SELECT source, tokens, docs, CASE WHEN tokens > 0 THEN pow(tokens / total, a) / z ELSE 0.0 END AS share, round(share, 9) AS weight, top * z / pow(top / total, a) AS budget FROM src, z),
du AS (SELECT *, CASE WHEN tokens > 0 THEN greatest(round(share * budget)::BIGINT, tokens) ELSE 0 END AS due FROM wt),
s AS (SELECT source, weight, greatest(1, ceil(docs / 4096))::BIGINT AS n, CASE WHEN tokens > 0 THEN (due // tokens)::INT ELSE 1 END AS f, CASE WHEN tokens > 0 THEN due % tokens ELSE 0 END AS rest FROM du),
pl AS (SELECT r.*, s.* EXCLUDE (source), ('0x' || substr(md5('1:block:' || doc_id), 1, 8))::BIGINT % n AS block FROM rows_ r JOIN s ON r.source IS NOT DISTINCT FROM s.source),
bl AS (SELECT source, f, rest, block, sum(tokens) AS t FROM pl WHERE rest > 0 GROUP BY ALL),
bb AS (SELECT *, coalesce(sum(t) OVER (PARTITION BY source ORDER BY md5('1:rank:' || f || ':' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM bl),
la AS (SELECT pl.*, before + sum(tokens) OVER (PARTITION BY pl.source, pl.block ORDER BY md5('1:place:' || pl.f || ':' || doc_id), doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM pl JOIN bb ON pl.source IS NOT DISTINCT FROM bb.source AND pl.block = bb.block WHERE before < bb.rest),
tk AS (SELECT doc_id, source, tokens, weight, block, unnest(range(0, f))::INT AS epoch FROM pl WHERE f > 0 UNION ALL SELECT doc_id, source, tokens, weight, block, f FROM la WHERE upto <= rest),
rk AS (SELECT source, block, epoch, row_number() OVER (PARTITION BY source, epoch ORDER BY md5('1:rank:' || epoch || ':' || block), block)::INT AS block_rank
  FROM (SELECT DISTINCT source, block, unnest(range(0, f + 1))::INT AS epoch FROM pl))
SELECT doc_id, tk.source, tokens AS n_tokens, weight, tk.epoch, block_rank, row_number() OVER (PARTITION BY tk.source, tk.block, tk.epoch ORDER BY md5('1:place:' || tk.epoch || ':' || doc_id), doc_id)::INT AS place
FROM tk JOIN rk ON tk.source IS NOT DISTINCT FROM rk.source AND tk.block = rk.block AND tk.epoch = rk.epoch
'''

ORACLE = {"op1_mixing": OP1, "op9_line_dedup": OP9, "op10_quality_rules": OP10}
