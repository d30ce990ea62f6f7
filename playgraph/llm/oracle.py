"""DuckDB SQL for the queries that SQL can express over whole tables."""

URL_FILTER = """
WITH rules(rhost, rpath, rule, verdict) AS (VALUES
  ('com', '/', 'com/', 'allow'),
  ('example.com', '/en/', 'example.com/en/', 'block'),
  ('www.example.com', '/en/', 'www.example.com/en/', 'allow'),
  ('net', '/es/', 'net/es/', 'block'),
  ('net', '/fr/', 'net/fr/', 'block')),
urls AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
hit AS (
  SELECT u.page_id, u.host, u.path, max(CASE WHEN r.rule IS NULL THEN NULL ELSE lpad(CAST(length(r.rule) AS VARCHAR), 9, '0') || r.rule END) AS best
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath)
  GROUP BY u.page_id, u.host, u.path)
SELECT h.page_id, h.host, h.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM hit h LEFT JOIN rules r ON r.rule = substr(h.best, 10)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
reach(a, b) AS (
  SELECT a, b FROM link
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
comp AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a),
links AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT x.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.component, x.vec_id) AS component_id,
       x.vec_id = coalesce(c.component, x.vec_id) AS kept
FROM embeddings x LEFT JOIN comp c ON c.a = x.vec_id LEFT JOIN links k ON k.a = x.vec_id
"""

#: Words are runs of anything but ASCII white space; a text of one word is one shingle.
NEAR_DOCUMENTS = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 1 THEN [words[1]]
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingle
  FROM w WHERE len(words) > 0),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- A pair of similarity 0.8 shares one of the rarest (n - ceil(0.8 n) + 1) shingles of each side.
freq AS (SELECT shingle, count(*) AS df FROM s GROUP BY shingle),
ranked AS (
  SELECT s.doc_id, s.shingle, z.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.df, s.shingle) AS place
  FROM s JOIN freq f USING (shingle) JOIN size z USING (doc_id)),
lead AS (SELECT doc_id, shingle, n FROM ranked WHERE place <= n - CAST(ceil(n * 0.8 - 1e-9) AS BIGINT) + 1),
cand AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb
  FROM lead a JOIN lead b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
pair AS (
  SELECT c.a, c.b FROM cand c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b AND y.shingle = x.shingle
  GROUP BY c.a, c.b, c.na, c.nb
  HAVING 100 * count(*) >= 80 * (c.na + c.nb - count(*))),
link AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach(a, b) AS (
  SELECT a, b FROM link
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
comp AS (SELECT a, least(a, min(b)) AS component FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(c.component, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component, d.doc_id) AS kept
FROM documents d LEFT JOIN size z ON z.doc_id = d.doc_id LEFT JOIN comp c ON c.a = d.doc_id
"""

#: Bytes as hexadecimal text, two characters each.
REPEATED_BYTES = """
WITH b AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
d AS (SELECT doc_id, h, len(h) // 2 AS n FROM b),
-- Windows are cut from pieces of 200 starts, so each substring call works on a short text.
part AS (
  SELECT doc_id, n, p, substr(h, 400 * p + 1, 598) AS h
  FROM (SELECT doc_id, h, n, unnest(range(0, (n - 100) // 200 + 1)) AS p FROM d WHERE n >= 100)),
w AS (
  SELECT doc_id, 200 * p + i AS start, hash(substr(h, 2 * i + 1, 200)) AS k
  FROM (SELECT doc_id, h, p, unnest(range(0, least(200, n - 99 - 200 * p))) AS i FROM part)),
f AS (SELECT k, min(doc_id * 1000000000 + start) AS first FROM w GROUP BY k HAVING count(*) > 1),
gone AS (
  SELECT w.doc_id, w.start FROM w JOIN f USING (k) WHERE w.doc_id * 1000000000 + w.start > f.first),
edge AS (
  SELECT doc_id, start, coalesce(start > lag(start) OVER (PARTITION BY doc_id ORDER BY start) + 100, true) AS opens FROM gone),
run AS (SELECT doc_id, start, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY start) AS r FROM edge),
span AS (SELECT doc_id, r, min(start) AS lo, max(start) + 100 AS hi FROM run GROUP BY doc_id, r),
piece AS (
  SELECT s.doc_id, s.lo, substr(d.h, 2 * coalesce(lag(s.hi) OVER (PARTITION BY s.doc_id ORDER BY s.lo), 0) + 1,
         2 * (s.lo - coalesce(lag(s.hi) OVER (PARTITION BY s.doc_id ORDER BY s.lo), 0))) AS kept
  FROM span s JOIN d USING (doc_id)),
front AS (SELECT doc_id, string_agg(kept, '' ORDER BY lo) AS kept FROM piece GROUP BY doc_id),
total AS (SELECT doc_id, sum(hi - lo) AS removed, count(*) AS spans, max(hi) AS last FROM span GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(t.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(t.spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(p.kept, '') || substr(d.h, 2 * coalesce(t.last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN total t USING (doc_id) LEFT JOIN front p USING (doc_id)
"""

#: Words between ASCII white space; lines of a host count once per distinct text.
QUALITY = """
WITH d AS (SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS x
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
dup AS (SELECT doc_id, x FROM win GROUP BY ALL HAVING count(*) > 1),
start AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM win JOIN dup USING (doc_id, x)),
rep AS (SELECT doc_id, CAST(sum(least(3, coalesce(nxt - i, 3))) AS BIGINT) AS n FROM start GROUP BY doc_id),
raw AS (SELECT doc_id, host, t, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (
  SELECT doc_id, host, t, line,
    regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\\x20\\x09-\\x0D]+', '', 'g') AS norm
  FROM raw),
again AS (SELECT doc_id, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n FROM lines WHERE norm <> '' GROUP BY doc_id),
docs AS (SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host),
hot AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT t) AS n FROM lines WHERE norm <> '' GROUP BY host, norm)
  JOIN docs USING (host) WHERE n > 5 AND n > 0.05 * docs),
lost AS (SELECT doc_id, count(*) AS n, CAST(sum(length(norm)) AS BIGINT) AS chars FROM lines JOIN hot USING (host, norm) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w.ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(d.t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(a.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS lost_lines, coalesce(l.chars, 0) AS lost_chars
  FROM d JOIN w USING (doc_id) LEFT JOIN again a USING (doc_id) LEFT JOIN rep r USING (doc_id) LEFT JOIN lost l USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 100 * lost_chars > 50 * word_chars AS depleted FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT depleted AS kept,
       lost_lines, lost_chars, depleted
FROM v
"""

#: CRC-32 byte by byte over all distinct features at once; ``tab`` is the byte table of the polynomial.
RESAMPLE = """
WITH RECURSIVE bits(b, k, r) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT b, r FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
e AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
df AS (
  SELECT doc_id, f, count(*) AS n FROM (
    SELECT doc_id, unnest(w) AS f FROM d
    UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM d WHERE len(w) > 1)
  GROUP BY doc_id, f),
ef AS (
  SELECT f, count(*) AS n FROM (
    SELECT unnest(w) AS f FROM e
    UNION ALL SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM e WHERE len(w) > 1)
  GROUP BY f),
names AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM ef)),
crc(f, h, i, r) AS (
  SELECT f, h, 0, CAST(4294967295 AS BIGINT) FROM names
  UNION ALL
  SELECT c.f, c.h, c.i + 1, xor(c.r >> 8, t.r)
  FROM crc c JOIN tab t ON t.b = xor(c.r & 255, CAST('0x' || substr(c.h, 2 * c.i + 1, 2) AS BIGINT))
  WHERE 2 * c.i < len(c.h)),
bucket AS (SELECT f, xor(r, 4294967295) % 10000 AS b FROM crc WHERE 2 * i = len(h)),
s AS (SELECT b, sum(n) AS n FROM df JOIN bucket USING (f) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM ef JOIN bucket USING (f) GROUP BY b),
total AS (SELECT coalesce((SELECT sum(n) FROM df), 0) AS s, coalesce((SELECT sum(n) FROM ef), 0) AS t),
gain AS (
  SELECT s.b, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * (total.s + 10000)::DOUBLE) / ((s.n + 1)::DOUBLE * (total.t + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (b), total),
mean AS (SELECT doc_id, sum(n) AS n, CAST(floor(sum(n * g)::DOUBLE / sum(n)::DOUBLE) AS BIGINT) AS w FROM df JOIN bucket USING (f) JOIN gain USING (b) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(d.w) >= 20 AS able, CAST(coalesce(m.n, 0) AS BIGINT) AS n_features, coalesce(m.w, 0) AS weight,
    coalesce(m.w, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN mean m USING (doc_id)),
place AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS able FROM scored WHERE able)
SELECT s.doc_id, s.n_features, s.weight, s.score, CASE WHEN p.r <= 25 * p.able // 100 THEN p.r END AS rank
FROM scored s LEFT JOIN place p USING (doc_id)
"""

#: All phrases of 1 to 5 words; a trailing space lets a phrase be looked for at word boundaries.
COLLOCATIONS = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, a FROM f WHERE k >= 2),
cut AS (
  SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
scored AS (
  SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r, n,
    CAST(1000::HUGEINT * cut.a * n // (x.a::HUGEINT * y.a) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = rest JOIN total t ON t.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
free AS (
  SELECT * FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM (
      SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, a
      FROM (SELECT lang, ws, k, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k)) s
    WHERE s.lang = b.lang AND s.phrase = b.phrase AND 100 * s.a >= 100 * b.a)),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place FROM free)
SELECT lang, place AS rank, phrase, a, l, r, n, score FROM placed WHERE place <= 2000
"""

ORACLE: dict[str, str] = {
    "op3_url_filter": URL_FILTER,
    "op5_vector_dups": NEAR_VECTORS,
    "op6_minhash": NEAR_DOCUMENTS,
    "op7_suffix_dedup": REPEATED_BYTES,
    "op10_topk": TOP_K,
    "op11_collocations": COLLOCATIONS,
    "op12_resampling": RESAMPLE,
    "op13_quality": QUALITY,
}
