"""DuckDB SQL for the queries that SQL can express.

The others need word hashes, a trained classifier, tokens, keyed permutations,
checksums, edit distances of hashed words or the cube method; tests/llm holds them against brute force.
"""

from __future__ import annotations

OP2 = r"""
WITH base AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds((page_id * 37) % 31536000) AS first_at,
         md5(coalesce(html, '')) AS payload_md5, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         'day-' || (page_id % 28) AS modified
  FROM pages),
records AS (
  SELECT *, 'a' AS part, first_at AS ts,
         [{'name': 'content-type', 'value': 'text/html'}, {'name': 'content-length', 'value': payload_bytes::VARCHAR},
          {'name': 'etag', 'value': '"' || payload_md5[1:16] || '"'}, {'name': 'last-modified', 'value': modified},
          {'name': 'cache-control', 'value': 'max-age=60'}] AS headers FROM base
  UNION ALL
  SELECT *, 'b', first_at + INTERVAL 1 DAY,
         [{'name': 'etag', 'value': 'W/"' || payload_md5[1:16] || '"'}, {'name': 'cache-control', 'value': 'max-age=3600'},
          {'name': 'age', 'value': '5'}] FROM base
  UNION ALL
  SELECT *, 'c', first_at + INTERVAL 2 DAY,
         CASE page_id % 3 WHEN 0 THEN [{'name': 'last-modified', 'value': modified}]
                          WHEN 1 THEN [{'name': 'etag', 'value': '"other"'}] ELSE [] END FROM base
  UNION ALL
  SELECT *, 'd', first_at - INTERVAL 1 HOUR,
         [{'name': 'etag', 'value': 'W/"' || payload_md5[1:16] || '"'}, {'name': 'cache-control', 'value': 'max-age=3600'},
          {'name': 'age', 'value': '5'}] FROM base WHERE page_id % 11 = 0),
split AS (
  SELECT lpad(page_id::VARCHAR, 20, '0') || part AS record_id, part, ts, headers, payload_md5, payload_bytes,
         regexp_replace(regexp_replace(lower(regexp_replace(regexp_extract(url, '^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)', 2),
                        '^.*@', '')), ':(80|443)?$', ''), '^www\.', '') AS host,
         regexp_replace(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
         list_sort(list_filter(string_split(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*[^?#]*\?([^#]*)', 1), '&'),
                   lambda f: f <> '' AND NOT regexp_matches(lower(f), '^(utm_[a-z]+|gclid|fbclid|msclkid)(=|$)'))) AS params
  FROM records),
named AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END END AS u
  FROM split),
responses AS (SELECT u, ts, max(record_id) AS refers_to FROM named WHERE part = 'a' AND u IS NOT NULL GROUP BY u, ts),
found AS (
  SELECT r.*, s.refers_to FROM (SELECT * FROM named WHERE part <> 'a') r ASOF LEFT JOIN responses s ON r.u = s.u AND r.ts > s.ts),
joined AS (
  SELECT f.record_id, f.u, f.ts, f.refers_to, f.headers AS fresh, s.headers AS stored, s.payload_md5 AS md5_was, s.payload_bytes AS bytes_was,
         list_filter(f.headers, lambda h: h.name = 'etag')[1].value AS tag, list_filter(f.headers, lambda h: h.name = 'last-modified')[1].value AS modified,
         list_filter(s.headers, lambda h: h.name = 'etag')[1].value AS tag_was, list_filter(s.headers, lambda h: h.name = 'last-modified')[1].value AS modified_was
  FROM found f LEFT JOIN named s ON f.refers_to = s.record_id),
judged AS (
  SELECT *, CASE WHEN u IS NULL THEN 'no_url' WHEN ts IS NULL THEN 'no_date' WHEN refers_to IS NULL THEN 'no_earlier_response'
                 WHEN tag IS NULL AND modified IS NULL THEN 'no_validator'
                 WHEN tag IS NOT NULL AND replace(tag, 'W/', '') = tag_was THEN 'resolved'
                 WHEN tag IS NULL AND modified = modified_was THEN 'resolved' ELSE 'mismatch' END AS status
  FROM joined)
SELECT record_id, u AS canonical_url, epoch(ts)::BIGINT AS captured, status, refers_to,
       CASE WHEN status = 'resolved' THEN array_to_string(list_transform(list_concat(
              list_filter(stored, lambda h: NOT list_contains(list_transform(fresh, lambda n: n.name), h.name)), fresh),
              lambda h: h.name || ': ' || h.value), chr(10)) END AS headers,
       CASE WHEN status = 'resolved' THEN md5_was END AS payload_md5, CASE WHEN status = 'resolved' THEN bytes_was END AS payload_bytes
FROM judged
"""

OP4 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (SELECT r, i, w[i:i + 4] AS g FROM cut, unnest(range(1, len(w) - 3)) AS u(i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) AS s(k) GROUP BY r),
counts AS (
  SELECT c.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals, length(t) - length(replace(t, '!', '')) AS n_shouts
  FROM cut c LEFT JOIN covered USING (r)),
shares AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END AS word_length,
         CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbol_share,
         CASE WHEN word_chars > 0 THEN 1000 * n_capitals // word_chars ELSE 0 END AS capital_share,
         CASE WHEN n_words > 0 THEN 1000 * n_shouts // n_words ELSE 0 END AS shout_share,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_line_share
  FROM counts),
long AS (
  UNPIVOT (SELECT r, lang, source, word_length::BIGINT AS word_length, symbol_share::BIGINT AS symbol_share,
                  capital_share::BIGINT AS capital_share, shout_share::BIGINT AS shout_share,
                  dup_line_share::BIGINT AS dup_line_share FROM shares)
  ON word_length, symbol_share, capital_share, shout_share, dup_line_share INTO NAME measure VALUE v),
bucketed AS (
  SELECT *, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS b FROM long),
levels AS (
  SELECT 'own' AS level, lang, source, measure, b, count(*) AS n FROM bucketed GROUP BY ALL
  UNION ALL SELECT 'lang', lang, NULL, measure, b, count(*) FROM bucketed GROUP BY ALL
  UNION ALL SELECT 'all', NULL, NULL, measure, b, count(*) FROM bucketed GROUP BY ALL),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY b) AS below,
         sum(n) OVER (PARTITION BY level, lang, source, measure) AS docs FROM levels),
quartiles AS (
  SELECT level, lang, source, measure, max(docs) AS docs, min(b) FILTER (WHERE 4 * below >= docs) AS q25,
         min(b) FILTER (WHERE 4 * below >= 3 * docs) AS q75 FROM ranked GROUP BY ALL),
chosen AS (
  SELECT o.lang, o.source, o.measure,
         (o.docs * o.q25 + 20 * ((l.docs * l.q25 + 20 * a.q25) // (l.docs + 20))) // (o.docs + 20) AS q25,
         (o.docs * o.q75 + 20 * ((l.docs * l.q75 + 20 * a.q75) // (l.docs + 20))) // (o.docs + 20) AS q75
  FROM quartiles o JOIN quartiles l ON l.level = 'lang' AND l.lang IS NOT DISTINCT FROM o.lang AND l.measure = o.measure
                   JOIN quartiles a ON a.level = 'all' AND a.measure = o.measure
  WHERE o.level = 'own'),
fences AS (
  SELECT lang, source, c.measure, q75 + 3 * greatest(q75 - q25, spread) AS most,
         CASE WHEN c.measure = 'word_length' THEN q25 - 3 * greatest(q75 - q25, spread) END AS least, place
  FROM chosen c JOIN (VALUES ('word_length', 1000, 1), ('symbol_share', 40, 2), ('capital_share', 40, 3), ('shout_share', 40, 4),
                             ('dup_line_share', 150, 5)) AS s(measure, spread, place) ON s.measure = c.measure),
beyond AS (
  SELECT r, string_agg(x.measure, ',' ORDER BY place) AS reasons
  FROM long x JOIN fences f ON f.lang IS NOT DISTINCT FROM x.lang AND f.source IS NOT DISTINCT FROM x.source AND f.measure = x.measure
  WHERE v > most OR v < least GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND reasons IS NULL AS kept, coalesce(reasons, '') AS reasons
FROM shares LEFT JOIN beyond USING (r)
"""

OP5 = """
WITH whole AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
  GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored) WHERE rank <= 5
"""

OP11 = """
WITH whole AS (
  SELECT vec_id, min({'l': CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END,
                      'v': list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)}) AS r FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
  GROUP BY vec_id),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.r.l = c.r.l AS same, list_inner_product(a.r.v::DOUBLE[], c.r.v::DOUBLE[])::BIGINT AS score
  FROM whole a JOIN whole c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

OP12 = """
WITH rows AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, row_number() OVER () AS r FROM documents),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST, r) AS place,
         max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM rows)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

ORACLE_SQL: dict[str, str] = {"op2_warc_revisits": OP2, "op4_quality_rules": OP4, "op5_exact_top_k": OP5, "op11_hard_negatives": OP11,
                              "op12_exact_dedup": OP12}
