"""Expected results in DuckDB SQL, written independently of the operators."""

QUALITY_RULES = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT k, i, array_to_string(list_slice(w, i, i + 7), chr(1)) AS s FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY k),
m AS (
  SELECT d.k, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep USING (k)),
f AS (
  SELECT k, source, unnest([
    {'r': 'words', 'f': n_words < 20}, {'r': 'repeats', 'f': 100 * n_repeat_words > 15 * n_words}, {'r': 'symbols', 'f': 100 * n_symbols > 8 * word_chars},
    {'r': 'lines', 'f': 100 * n_dup_lines > 25 * n_lines}, {'r': 'long_words', 'f': word_chars > 15 * n_words}], recursive := true) FROM m),
h AS (SELECT source, r, count(*) AS n, CAST(sum(CAST(f AS INT)) AS DOUBLE) AS x FROM f GROUP BY source, r),
mo AS (SELECT r, sum(x) / sum(n) AS mean, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) ** 2 AS spread FROM h GROUP BY r),
pr AS (SELECT r, mean, CASE WHEN spread > 0 THEN least(1000.0, greatest(2.0, mean * (1 - mean) / spread - 1)) ELSE 1000.0 END AS weight FROM mo),
bad AS (SELECT source, r FROM h JOIN pr USING (r) WHERE (x + mean * weight) / (n + weight) > 0.4),
hf AS (SELECT DISTINCT f.k FROM f JOIN bad ON f.r = bad.r AND f.source IS NOT DISTINCT FROM bad.source WHERE f.f)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, hf.k IS NOT NULL AS host_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND hf.k IS NULL AS kept, source
FROM m LEFT JOIN hf USING (k)
"""

CHAT_FORMAT = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(nullif(trim(role, ' '), ''), 'unknown') AS speaker, text FROM conversations),
l AS (
  SELECT *, (sum(length(CASE WHEN speaker = 'system' THEN '<|system|>' ELSE '<|user|>' || speaker END) + 1 + length(coalesce(text, '')) + 8)
               OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS upto FROM t),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
p AS (
  SELECT l.conv_id, CAST(coalesce(upto, 0) AS BIGINT) // 1048576 AS block, who.perspective, l.turn, l.speaker, l.text, l.speaker = who.perspective AS own,
         CASE WHEN l.speaker = who.perspective THEN '<|assistant|>' WHEN l.speaker = 'system' THEN '<|system|>' ELSE '<|user|>' || l.speaker END || chr(10) AS head,
         coalesce(l.text, '') || '<|end|>' || chr(10) AS body
  FROM l JOIN who ON l.conv_id IS NOT DISTINCT FROM who.conv_id),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective
              ORDER BY turn NULLS FIRST, speaker, text NULLS FIRST ROWS UNBOUNDED PRECEDING) - length(body) AS s FROM p)
SELECT conv_id, block, perspective, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, speaker, text NULLS FIRST) AS rendered,
       coalesce(string_agg(CAST(s AS BIGINT) || '-' || CAST(s + length(body) - 1 AS BIGINT), ',' ORDER BY turn NULLS FIRST, speaker, text NULLS FIRST) FILTER (own), '') AS mask_spans
FROM o GROUP BY conv_id, block, perspective
"""

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT k, i, hash(list_slice(w, i, i + 34)) AS h, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS s
        FROM (SELECT k, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY h, s) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT k, unnest(range(i, i + 35)) AS p FROM twice),
word AS (SELECT k, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT k, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (k, p) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (k)
"""

NEAR_DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) c USING (doc_id)
"""

MERKLE_MANIFEST = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id, lang,
         [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS f,
         list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c:
           [ascii(c), 256, 256, 256, 256, 256, 256, 256, 256]))), lambda c, s: CASE WHEN s < 256 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
  FROM documents),
h AS (
  SELECT k, doc_id, lang, xor(crc, 4294967295) % 3 = 0 AS bad,
         list_transform(f, lambda x: coalesce(CAST(octet_length(encode(x)) AS VARCHAR) || ':' || x, '-')) AS g,
         list_transform(list_concat(f[1:4], [translate(f[5], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')]),
           lambda x: coalesce(CAST(octet_length(encode(x)) AS VARCHAR) || ':' || x, '-')) AS g2
  FROM d),
l AS (SELECT k, doc_id, lang, sha256(array_to_string(g, '')) AS leaf, CASE WHEN bad THEN sha256(array_to_string(g2, '')) ELSE sha256(array_to_string(g, '')) END AS now FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY lang) AS n FROM l),
t AS (
  SELECT 0 AS lvl, lang, rank, n, leaf AS digest FROM r
  UNION ALL
  SELECT any_value(lvl) + 1, lang, rank // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank)) FROM t WHERE n > 1 GROUP BY lang, rank // 8),
s AS (SELECT lang, digest AS subroot, lvl AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, rank, n, subroot AS digest FROM s
  UNION ALL
  SELECT any_value(lvl) + 1, rank // 8, (any_value(n) + 7) // 8, sha256(string_agg(digest, '' ORDER BY rank)) FROM u WHERE n > 1 GROUP BY rank // 8),
a AS (
  SELECT x.lvl, x.lang, x.rank, coalesce(string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank < x.rank), '') AS lft, coalesce(string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank > x.rank), '') AS rgt
  FROM t x JOIN t y ON x.lvl = y.lvl AND x.lang IS NOT DISTINCT FROM y.lang AND x.rank // 8 = y.rank // 8 WHERE x.n > 1 GROUP BY ALL),
b AS (
  SELECT x.lvl, x.rank, coalesce(string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank < x.rank), '') AS lft, coalesce(string_agg(y.digest, '' ORDER BY y.rank) FILTER (y.rank > x.rank), '') AS rgt
  FROM u x JOIN u y ON x.lvl = y.lvl AND x.rank // 8 = y.rank // 8 WHERE x.n > 1 GROUP BY ALL),
p AS (
  SELECT r.k, a.lvl, a.lft, a.rgt FROM r JOIN a ON r.lang IS NOT DISTINCT FROM a.lang AND r.rank // CAST(8 ** a.lvl AS BIGINT) = a.rank
  UNION ALL
  SELECT r.k, s.height + b.lvl, b.lft, b.rgt FROM r JOIN s ON r.lang IS NOT DISTINCT FROM s.lang JOIN b ON s.rank // CAST(8 ** b.lvl AS BIGINT) = b.rank),
fold AS (
  SELECT k, 0 AS lvl, now AS digest FROM r
  UNION ALL
  SELECT fold.k, fold.lvl + 1, sha256(p.lft || digest || p.rgt) FROM fold JOIN p ON fold.k = p.k AND fold.lvl = p.lvl),
top AS (SELECT k, arg_max(digest, lvl) AS folded_root FROM fold GROUP BY k),
pr AS (SELECT k, string_agg(lft || rgt, '' ORDER BY lvl) AS proof FROM p GROUP BY k)
SELECT r.doc_id, r.leaf, s.subroot, u.digest AS root, sha256(coalesce(pr.proof, '')) AS proof_sha256, top.folded_root, top.folded_root = u.digest AS verified
FROM r JOIN s ON r.lang IS NOT DISTINCT FROM s.lang JOIN u ON u.n = 1 JOIN top USING (k) LEFT JOIN pr USING (k)
"""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
f AS (SELECT body, min(page_id) AS first FROM p GROUP BY body),
r AS (SELECT p.*, f.first, row_number() OVER (PARTITION BY p.body ORDER BY page_id NULLS LAST) AS turn FROM p JOIN f USING (body)),
b AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substr(sha1(body), CAST(5 * i + 1 AS BIGINT), 5) AS BIGINT)) AS v FROM r)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
       list_aggregate(list_transform(v, lambda n: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((n >> s) & 31 AS BIGINT) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
       CASE WHEN turn = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN turn = 1 THEN NULL ELSE first END AS refers_to
FROM b
"""
