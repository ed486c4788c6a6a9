"""DuckDB SQL of the queries that SQL can state."""

#: Lines on 10 distinct sources or more go from every document but the one with the smallest doc_id.
LINE_SPREAD = r"""
WITH p AS (SELECT doc_id, source, string_split(text, chr(10)) AS arr FROM documents),
l AS (SELECT doc_id, source, unnest(arr) AS line, generate_subscripts(arr, 1) AS pos FROM p),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS t FROM l),
s AS (SELECT t, min(doc_id) AS first_doc FROM k WHERE t <> '' GROUP BY t
      HAVING count(DISTINCT coalesce('=' || source, 'null')) >= 10),
m AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id > s.first_doc, false) AS gone FROM k LEFT JOIN s USING (t)),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE a.n END::BIGINT AS n_lines,
       coalesce(a.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(a.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN a USING (doc_id)
"""

#: Items of which 80 % or more of the distinct 5-word shingles occur in the document.
CONTAINMENT = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
s AS (
  SELECT kind, id, unnest(CASE WHEN len(w) >= 5
           THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY id),
m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
      FROM s i JOIN s d ON i.s = d.s AND i.kind = 'i' AND d.kind = 'd' GROUP BY d.id, i.id)
SELECT doc_id, item_id, n::BIGINT AS n_item, shared::BIGINT AS n_shared FROM m JOIN n ON n.id = m.item_id
WHERE 5 * shared >= 4 * n
"""

#: Documents linked at Jaccard similarity 0.85 or more of distinct 3-word shingles, and the smallest id they reach.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 3
           THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')))
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id
      GROUP BY x.doc_id, y.doc_id),
l AS MATERIALIZED (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS root FROM documents
      UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.a AND r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.root AS component_id, d.doc_id = m.root AS kept
FROM documents d JOIN (SELECT a, min(root) AS root FROM r GROUP BY a) m ON m.a = d.doc_id LEFT JOIN n USING (doc_id)
"""

#: Vectors linked at cosine 0.95 or more in double precision.
SIMILAR_VECTORS = r"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
e AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a),
r AS (SELECT vec_id AS a, vec_id AS root FROM embeddings
      UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.a AND r.root < e.b)
SELECT d.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, m.root AS component_id, d.vec_id = m.root AS kept
FROM embeddings d JOIN (SELECT a, min(root) AS root FROM r GROUP BY a) m ON m.a = d.vec_id LEFT JOIN n ON n.a = d.vec_id
"""

#: Bytes covered by a 50-byte string that also starts in a document with a smaller doc_id (on hex digits of the bytes).
SUFFIX_REPEATS = r"""
WITH h AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s
      FROM (SELECT doc_id, x, unnest(range(0, (length(x) // 2) - 49)) AS i FROM h)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1),
g AS (SELECT w.doc_id, w.i FROM w JOIN f USING (s) WHERE f.first < w.doc_id),
o AS (SELECT doc_id, i, coalesce(i > lag(i) OVER p + 50, true) AS new FROM g WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b
      FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o) GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS prev FROM r),
c AS (SELECT k.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
             string_agg(substr(x, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS kept, max(b) AS last
      FROM k JOIN h USING (doc_id) GROUP BY k.doc_id)
SELECT h.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(c.kept, '') || substr(x, 2 * coalesce(c.last, 0) + 1))) AS kept_sha256
FROM h LEFT JOIN c USING (doc_id)
"""

#: Hashed 1- and 2-word features, gains of their buckets, and the highest Gumbel scores; CRC-32 spelt out over bytes.
RESAMPLING = r"""
WITH tab AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
w AS MATERIALIZED (
  SELECT false AS target, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT true, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
f AS MATERIALIZED (
  SELECT target, id, f, count(*) AS n
  FROM (SELECT target, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
        FROM w) GROUP BY target, id, f),
c AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2),
           lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
         lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM f)), tab),
b AS MATERIALIZED (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE NOT target), 0) AS s, coalesce(sum(n) FILTER (WHERE target), 0) AS t
  FROM f JOIN c USING (f) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM b),
m AS (
  SELECT f.id AS doc_id, sum(n) AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM f JOIN c USING (f) JOIN g USING (bucket) WHERE NOT target GROUP BY f.id),
k AS MATERIALIZED (
  SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(m.n_features, 0)::BIGINT AS n_features,
         coalesce(m.weight, 0)::BIGINT AS weight,
         coalesce(m.weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || w.id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                         / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN m ON m.doc_id = w.id WHERE NOT w.target),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM k WHERE n_words >= 20)
SELECT k.doc_id, n_features, weight, score, CASE WHEN r.rank <= 25 * r.n // 100 THEN r.rank END::BIGINT AS rank
FROM k LEFT JOIN r USING (doc_id)
"""

#: What each of five filters removes by part, order and step.
FILTER_AUDIT = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l USING (doc_id)),
n AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step::INTEGER AS step, filter_order[step] AS x, filter_order[1:step - 1] AS earlier
      FROM o, range(1, 6) r(step)),
c AS (SELECT part, filter_order, step, x, n, good, toxic, fails = x AS sole, contains(fails, x) AS bad,
             earlier <> '' AND regexp_matches(fails, '[' || earlier || '_]') AS gone FROM n, s),
r AS (SELECT part, filter_order, step, x,
             coalesce(sum(n) FILTER (WHERE NOT bad AND NOT gone), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (WHERE bad AND NOT gone), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (WHERE bad AND gone), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (WHERE sole), 0)::BIGINT AS unique_fails,
             coalesce(sum(n) FILTER (WHERE bad AND NOT gone AND good), 0)::BIGINT AS good_lost,
             coalesce(sum(n) FILTER (WHERE bad AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
      FROM c GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley FROM r
"""

#: Turns and assistant texts by conversation. Formatted sizes: a turn's markers, its text, one character more for each
#: backslash and two more for each marker in it.
CHAT_FORMATTING = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + len(regexp_extract_all(text, '\\'))
         + 2 * len(regexp_extract_all(text, '\[/?(?:SYS|INST|ROLE)\]|\[(?:ANS|AS)\]|</?s>|</?pages>|<image>|<audio>|<document>')) AS n_text,
         length(role) + len(regexp_extract_all(role, '\\'))
         + 2 * len(regexp_extract_all(role, '\[/?(?:SYS|INST|ROLE)\]|\[(?:ANS|AS)\]|</?s>|</?pages>|<image>|<audio>|<document>')) AS n_role
      FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(n_text + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11 ELSE 21 + n_role END)::BIGINT
         AS formatted_chars,
       0::BIGINT AS n_attachments, 0::BIGINT AS expanded_tokens
FROM e GROUP BY conv_id
"""
