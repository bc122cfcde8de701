"""DuckDB SQL twins of the training-data queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_STRIP = "trim({0}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP1 = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS keeper FROM p
  WHERE payload_bytes >= 1000 GROUP BY ALL HAVING count(*) > 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN k.keeper IS NULL OR k.keeper = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k.keeper <> p.page_id THEN k.keeper END AS refers_to,
       true AS digest_ok
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND p.payload_bytes = k.payload_bytes
"""

# Containment of every item in every document, without a sketch.
OP2 = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM dw WHERE len(w) > 0)),
items AS (
  SELECT DISTINCT item_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM iw WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n FROM items GROUP BY item_id)
SELECT doc_id, item_id, any_value(n) AS item_shingles, count(*) AS matched
FROM ds JOIN items USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 75 * any_value(n)
"""

_ESCAPE = r"regexp_replace(regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g'), '\|(\\*)>', '|\\\1>', 'g')"
OP3 = f"""
WITH base AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS body FROM conversations),
people AS (SELECT DISTINCT conv_id AS c, speaker AS participant FROM base WHERE speaker <> 'system'),
shown AS (
  SELECT *, speaker <> 'system' AND speaker = participant AS own,
         CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10)
              WHEN speaker = participant THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || {_ESCAPE.format('speaker')} || '|>' || chr(10) END AS head,
         {_ESCAPE.format('body')} || '<|end|>' AS rest
  FROM base JOIN people ON conv_id IS NOT DISTINCT FROM c),
placed AS (
  SELECT *, sum(length(head) + length(rest) + 1) OVER (
           PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, body
           ROWS UNBOUNDED PRECEDING) - length(rest) - 1 AS s
  FROM shown)
SELECT conv_id, participant, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || rest || chr(10), '' ORDER BY turn NULLS FIRST, speaker, body) AS rendered,
       coalesce(string_agg(CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(s + length(rest) AS BIGINT) AS VARCHAR), ','
                           ORDER BY turn NULLS FIRST, speaker, body) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, participant
"""

OP6 = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, translate({_STRIP.format('line')}, {_UP}, {_LOW}) AS key FROM l),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
flagged AS (
  SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS gone
  FROM k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
"""

# All pairs that share a shingle, exact similarity, and reachability: brute force.
OP8 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UP}, {_LOW}), '{_WORD}') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * (any_value(na.n) + any_value(nb.n) - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, links.b FROM reach JOIN links ON reach.y = links.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.y) AS component_id,
       d.doc_id = min(reach.y) AS kept
FROM documents d JOIN reach ON reach.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
"""

OP9 = f"""
WITH t AS (
  SELECT doc_id, coalesce(source, chr(0)) AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (
  SELECT doc_id, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
twice AS (SELECT doc_id, g FROM win GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM win JOIN twice USING (doc_id, g)) GROUP BY doc_id),
l AS (
  SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM t),
k AS (
  SELECT doc_id, host, line, translate({_STRIP.format('line')}, {_UP}, {_LOW}) AS key FROM l),
dup AS (
  SELECT doc_id, sum(c - 1) AS n_dup_lines FROM (
    SELECT doc_id, line, count(*) AS c FROM k WHERE key <> '' GROUP BY doc_id, line) GROUP BY doc_id),
f AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed
  FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)),
common AS (SELECT host, key FROM k WHERE key <> '' GROUP BY host, key HAVING count(DISTINCT doc_id) > 20),
held AS (SELECT doc_id, host, key, len(regexp_extract_all(key, '{_WORD}')) AS words FROM k JOIN common USING (host, key)),
passing AS (
  SELECT doc_id, 100 * (any_value(n_words) - sum(words)) >= 30 * any_value(n_words) AS safe
  FROM held JOIN f USING (doc_id) WHERE NOT base_failed GROUP BY doc_id),
keepers AS (
  SELECT host, key, max_by(doc_id, (CASE WHEN safe THEN 1 ELSE 0 END, doc_id)) AS keeper
  FROM held JOIN passing USING (doc_id) GROUP BY host, key),
gone AS (
  SELECT doc_id, sum(CASE WHEN keeper = doc_id THEN 0 ELSE words END) AS removed, bool_or(coalesce(keeper = doc_id, false)) AS keeps
  FROM held LEFT JOIN keepers USING (host, key) GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (coalesce(keeps, false) OR 100 * (n_words - coalesce(removed, 0)) >= 30 * n_words) AS kept,
       CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
FROM f LEFT JOIN gone USING (doc_id)
"""

# CRC-32 of a short ASCII string, bit by bit; backward costs and the walk of tight edits by recursion.
OP11 = rf"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
dealt AS (
  SELECT *, xor(list_reduce(
    list_transform(range(1, length(key) + 1), lambda i: CAST(ascii(substr(key, CAST(i AS INT), 1)) AS BIGINT)),
    lambda c, x: xor(list_reduce(range(8), lambda t, i: CASE WHEN t % 2 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END,
                                 xor(c, x) & 255), c >> 8),
    CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 20 AS d FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM (SELECT *, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy FROM dealt WHERE d <> 0)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         count(*) OVER (PARTITION BY conv_id) AS n,
         left(role, 1) AS c, r{_STRIP.format('text')} AS body FROM damaged),
k AS (
  SELECT *, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS c0,
         CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(body, 1) IN ('.', '!', '?') THEN 'none' ELSE 'truncated' END AS kind FROM placed),
e AS (SELECT *, kind IN ('blank', 'duplicate') AS g, CASE WHEN kind = 'truncated' THEN 5 ELSE 0 END AS t FROM k),
back AS (
  SELECT conv_id, n + 1 AS i, [0, 10, 5, 0] AS v FROM e GROUP BY conv_id, n
  UNION ALL
  SELECT conv_id, i, [least(s, 5 + u, 10 + a), least(p, 5 + u, 10 + a), least(u, 5 + a), least(a, 5 + u)]
  FROM (SELECT e.conv_id, e.i,
               least(2 + v[1], CASE WHEN NOT g THEN 1 + t + v[3] END, CASE WHEN NOT g AND c = 's' THEN t + v[2] END,
                     CASE WHEN NOT g AND c = 'u' THEN t + v[3] END) AS s,
               least(2 + v[2], CASE WHEN NOT g THEN 1 + t + v[3] END, CASE WHEN NOT g AND c = 'u' THEN t + v[3] END) AS p,
               least(2 + v[3], CASE WHEN NOT g THEN 1 + t + v[4] END, CASE WHEN NOT g AND c = 'a' THEN t + v[4] END) AS u,
               least(2 + v[4], CASE WHEN NOT g THEN 1 + t + v[3] END, CASE WHEN NOT g AND c = 'u' THEN t + v[3] END) AS a
        FROM back JOIN e ON e.conv_id IS NOT DISTINCT FROM back.conv_id AND e.i = back.i - 1)),
steps AS (
  SELECT h.conv_id, h.i, h.v AS here, nxt.v AS after, e.c, e.g, e.t, e.role, e.text
  FROM back h LEFT JOIN back nxt ON nxt.conv_id IS NOT DISTINCT FROM h.conv_id AND nxt.i = h.i + 1
  LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM h.conv_id AND e.i = h.i),
walk AS (
  SELECT conv_id, CAST(1 AS BIGINT) AS i, 1 AS q, '' AS audit, CAST(NULL AS VARCHAR) AS turns, CAST(0 AS BIGINT) AS cost
  FROM e GROUP BY conv_id
  UNION ALL
  SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END, CASE edit WHEN 'D' THEN q WHEN 'K' THEN keep ELSE succ END,
         audit || edit,
         CASE WHEN edit = 'D' THEN turns ELSE coalesce(turns || chr(10), '') || CASE edit WHEN 'K' THEN role || ':' || text
              WHEN 'R' THEN named || ':' || text ELSE named || ':' END END,
         cost + CASE edit WHEN 'D' THEN 2 WHEN 'I' THEN 5 WHEN 'K' THEN t ELSE 1 + t END
  FROM (SELECT *, CASE WHEN after IS NULL THEN 'I' WHEN here[q] = 2 + after[q] THEN 'D' WHEN here[q] = 5 + here[succ] THEN 'I'
                       WHEN NOT g AND keep IS NOT NULL AND here[q] = t + after[keep] THEN 'K' ELSE 'R' END AS edit
        FROM (SELECT w.*, s.here, s.after, s.c, s.g, s.t, s.role, s.text,
                     CASE WHEN q = 3 THEN 4 ELSE 3 END AS succ, CASE WHEN q = 3 THEN 'assistant' ELSE 'user' END AS named,
                     CASE WHEN c = 's' AND q = 1 THEN 2 WHEN c = 'u' AND q <> 3 THEN 3 WHEN c = 'a' AND q = 3 THEN 4 END AS keep
              FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i
              WHERE s.after IS NOT NULL OR q NOT IN (1, 4)))),
done AS (SELECT w.* FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i
         WHERE s.after IS NULL AND q IN (1, 4)),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (kind = 'blank') AS blank,
         count(*) FILTER (kind = 'duplicate') AS duplicate, count(*) FILTER (kind = 'truncated') AS truncated,
         count(*) FILTER (c0 IS NOT NULL AND c0 || c NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(d.cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(turns, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP12 = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size, row_number() OVER () AS rid,
         md5(coalesce(CAST(doc_id AS VARCHAR), ' ') || ':' || coalesce(text, '')) AS h FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source),
bud AS (SELECT sum(source_size) * 150 / 100.0 AS b FROM sizes),
src AS (
  SELECT *, 2.0 * source_size AS cap, CAST([3, 1, 2][CAST(place % 3 AS INT) + 1] AS DOUBLE) AS w
  FROM (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM sizes)),
level AS (
  SELECT CAST(0 AS DOUBLE) AS l
  UNION
  SELECT (CAST(b AS DOUBLE) - coalesce(sum(CASE WHEN cap < w * l THEN cap END), 0)) / sum(CASE WHEN cap >= w * l THEN w END)
  FROM level, src, bud GROUP BY l, b),
goal AS (SELECT source, source_size, place, least(cap, w * (SELECT max(l) FROM level)) AS target FROM src),
queue AS (
  SELECT rid, size, place, target, source_size, CAST(sum(size) OVER (PARTITION BY place ORDER BY h, rid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM rows JOIN goal ON rows.source IS NOT DISTINCT FROM goal.source),
copies AS (
  SELECT rid, size, place, upto, epoch, CAST(source_size * epoch + upto AS DOUBLE) / target AS finish
  FROM (SELECT *, unnest([0, 1]) AS epoch FROM queue WHERE size > 0)),
mixed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, epoch, upto ROWS UNBOUNDED PRECEDING) AS total FROM copies),
taken AS (SELECT rid, sum(size) AS taken FROM mixed WHERE total <= (SELECT b FROM bud) GROUP BY rid)
SELECT doc_id, CAST(rows.size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM rows JOIN goal ON rows.source IS NOT DISTINCT FROM goal.source LEFT JOIN taken USING (rid)
"""

OP13 = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {_UP}, {_LOW}) AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
g AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, w, unnest(range(1, 6)) AS m FROM p) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n.n,
         (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1:], ' ') JOIN n ON n.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[s:s + z - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, a, w, z, unnest(range(1, m - z + 2)) AS s FROM (SELECT *, unnest(range(2, m)) AS z FROM c WHERE m >= 3))
  GROUP BY ALL),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""

SQL = {"op1_warc": OP1, "op2_decontamination": OP2, "op3_chat_formatting": OP3, "op6_line_dedup": OP6,
       "op8_near_dedup": OP8, "op9_quality_rules": OP9,
       "op11_conversation_repair": OP11, "op12_source_mixing": OP12, "op13_collocations": OP13}
