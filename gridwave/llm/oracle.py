"""DuckDB SQL with the results of the training-data queries, where SQL can say it."""

SQL: dict[str, str] = {}
SQL["op9_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win)
        WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, range(8) r(j) GROUP BY doc_id),
f AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             len(lines) AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov ON cov.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_symbols <= 25 * n_words AND 100 * n_dup_lines <= 30 * n_lines
       AND word_chars BETWEEN 2 * n_words AND 15 * n_words AS kept
FROM b
"""

SQL["op7_url_filter"] = r"""
WITH cap AS (
  SELECT page_id, DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INTEGER) AS fetch_day,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '.'), '') AS host
  FROM pages),
hosts AS (SELECT DISTINCT host FROM cap WHERE host IS NOT NULL),
pat AS (SELECT host AS p FROM hosts UNION SELECT regexp_extract(host, '([^.]+\.[^.]+)$', 1) FROM hosts),
ent AS (SELECT p, i, ('0x' || md5(p)[1:2])::INTEGER % 4 AS n,
               ['adult', 'malware', 'spam'][('0x' || md5(p)[3:4])::INTEGER % 3 + 1] AS category,
               DATE '2024-01-01' + CAST(('0x' || md5(p)[5 + 2 * i:6 + 2 * i])::INTEGER % 120 + 120 * i AS INTEGER) AS day
        FROM pat, (VALUES (0), (1), (2)) v(i) WHERE p <> ''),
span AS (SELECT p, category, i, day AS f, coalesce(lead(day) OVER (PARTITION BY p ORDER BY day), DATE '9999-12-31') AS u
         FROM ent WHERE i < n),
hit AS (SELECT host, fetch_day, count(*) AS n_active, string_agg(DISTINCT category, ',' ORDER BY category) AS categories
        FROM (SELECT DISTINCT host, fetch_day FROM cap) c
        JOIN span ON (host = p OR ends_with(host, '.' || p)) AND i <> 1 AND f <= fetch_day AND fetch_day < u
        GROUP BY host, fetch_day)
SELECT page_id, cap.host, strftime(cap.fetch_day, '%Y-%m-%d') AS fetch_day, n_active IS NOT NULL AS blocked,
       coalesce(n_active, 0)::BIGINT AS n_active, coalesce(categories, '') AS categories
FROM cap LEFT JOIN hit ON cap.host = hit.host AND cap.fetch_day = hit.fetch_day
"""

# The masks miss no overlap, so that comparing all words gives the same rows.
SQL["op1_decontamination"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws
           FROM documents WHERE text IS NOT NULL),
b AS (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws
      FROM benchmark WHERE text IS NOT NULL),
dw AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM d),
bw AS (SELECT item_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS j FROM b),
pair AS (SELECT doc_id, item_id, n, i - j AS start, j FROM dw JOIN bw USING (w)),
diag AS (SELECT doc_id, item_id, n, start, count(*) AS matched FROM pair GROUP BY ALL HAVING count(*) >= ceil(0.8 * least(15, n))),
near AS (SELECT doc_id, item_id, p.n, start, matched,
                count(*) OVER (PARTITION BY doc_id, item_id, start ORDER BY j
                               RANGE BETWEEN 14 PRECEDING AND CURRENT ROW) AS c
         FROM pair p JOIN diag USING (doc_id, item_id, start)),
best AS (SELECT doc_id, item_id, n, start, matched, max(c) AS c FROM near GROUP BY ALL HAVING max(c) >= ceil(0.8 * least(15, n)))
SELECT doc_id, item_id, start::BIGINT AS first_word, matched::BIGINT AS n_matched, n::BIGINT AS n_item_words,
       c / least(15, n)::DOUBLE AS share
FROM best QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, start) = 1
"""

SQL["op5_lm_scoring"] = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT rid, i, w, lag(w) OVER s AS v, lag(w, 2) OVER s AS u FROM w WINDOW s AS (PARTITION BY rid ORDER BY i)),
c1 AS (SELECT w, count(*) AS n FROM g GROUP BY w),
c2 AS (SELECT v, w, count(*) AS n FROM g WHERE v IS NOT NULL GROUP BY v, w),
c3 AS (SELECT u, v, w, count(*) AS n FROM g WHERE u IS NOT NULL GROUP BY u, v, w),
s AS (SELECT g.rid,
        CASE WHEN c3.n > 0 THEN ln(c3.n / p2.n) WHEN c2.n > 0 THEN ln(c2.n / p1.n)
             ELSE ln(c1.n / (SELECT count(*) FROM g)) END
        + ln(0.4) * (least(i - 1, 2) - CASE WHEN c3.n > 0 THEN 2 WHEN c2.n > 0 THEN 1 ELSE 0 END) AS s,
        CASE WHEN c3.n > 0 THEN 2 WHEN c2.n > 0 THEN 1 ELSE 0 END < least(i - 1, 2) AS b
      FROM g JOIN c1 ON c1.w = g.w LEFT JOIN c2 ON c2.v = g.v AND c2.w = g.w
      LEFT JOIN c3 ON c3.u = g.u AND c3.v = g.v AND c3.w = g.w
      LEFT JOIN c1 p1 ON p1.w = g.v LEFT JOIN c2 p2 ON p2.v = g.u AND p2.w = g.v),
t AS (SELECT rid, count(*) AS n, sum(s) AS s, count(*) FILTER (WHERE b) AS b FROM s GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(coalesce(s, 0), 4)::DOUBLE AS log_score,
       round(s / n, 4)::DOUBLE AS mean_log_score, coalesce(b, 0)::BIGINT AS n_backoff
FROM d LEFT JOIN t ON t.rid = d.rid
"""

# CRC-32 by its table of 256 entries, made from the polynomial.
SQL["op12_importance_resampling"] = r"""
WITH RECURSIVE e(b, k, c) AS (
  SELECT b, 0, b FROM range(256) r(b)
  UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM e WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM e WHERE k = 8),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
dw AS (SELECT rid, unnest(ws) AS w FROM d),
bw AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
hx AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
bk AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2),
              lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT)),
              lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]))) % 10000 AS bucket FROM hx, tab),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN bk USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN bk USING (w) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE)
                / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS g
         FROM s LEFT JOIN t USING (bucket)),
wt AS (SELECT rid, count(*) AS n, sum(g) AS g FROM dw JOIN bk USING (w) JOIN gain USING (bucket) GROUP BY rid),
sc AS (SELECT doc_id, len(ws) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(g, 0)::BIGINT AS weight,
              (coalesce(g, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE)
                                                     / 4294967296::DOUBLE))))::BIGINT AS score
       FROM d LEFT JOIN wt USING (rid)),
r AS (SELECT *, CASE WHEN n_words >= 20
                THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place FROM sc)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 10 * (SELECT count(*) FROM sc WHERE n_words >= 20) // 100 THEN place END AS rank
FROM r
"""

SQL["op13_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
