"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

from __future__ import annotations

from tillroll.llm.simhash_sql import SIMHASH_NEAR_DEDUP

URL_FILTER = """
WITH cut AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
fit AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM cut)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM fit
"""

# A document's words as numbers; a window is a list of 50 of them, kept if it
# starts in a document with a smaller id; its words are covered.
SUBSTRING_DEDUP = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, unnest(generate_series(1, len(words) - 49)) AS s, words FROM w),
keyed AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 49], ' ')) AS h FROM win),
hit AS (SELECT doc_id, s FROM (
  SELECT doc_id, s, min(doc_id) OVER (PARTITION BY h) AS first FROM keyed) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 49)) AS pos FROM hit),
lost AS (SELECT doc_id, list(pos) AS poss FROM gone GROUP BY doc_id),
parts AS (SELECT doc_id, unnest(words) AS word, unnest(generate_series(1, len(words))) AS pos FROM w),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.pos) AS body
  FROM parts p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos
  WHERE g.pos IS NULL GROUP BY p.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(coalesce(len(poss), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
  FROM documents),
t AS (
  SELECT rid, lang, source,
         unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
vocab AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM vocab GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN vocab USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
q AS (
  SELECT lang, term,
         CAST(1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS BIGINT) AS q
  FROM vocab JOIN langs USING (lang)),
p AS (
  SELECT g.lang, g.source, vocab.term, coalesce(c.n, 0) AS n,
         CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(totals.total, 0) + 2 * v) AS BIGINT) AS p
  FROM g JOIN vocab USING (lang) JOIN langs USING (lang)
  LEFT JOIN totals ON totals.lang = g.lang AND totals.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = vocab.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item,
         CAST(coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
more AS (
  SELECT lang, source, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM pair
  UNION ALL
  SELECT * FROM (
    SELECT lang, source, 'term', item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS r FROM more)
  WHERE r <= 10)
SELECT lang, source, part, item, value, CAST(r AS INTEGER) AS rank FROM ranked
"""

EMBEDDING_NEAR_DEDUP = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM ok a
  JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT u, v FROM link
  UNION SELECT reach.u, link.v FROM reach JOIN link ON reach.v = link.u),
least AS (SELECT u, min(v) AS v FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n FROM link GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.v, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least.v, vec_id)) AS kept
FROM embeddings e LEFT JOIN least ON least.u = e.vec_id LEFT JOIN degree ON degree.u = e.vec_id
"""

# CRC-32 bit by bit; then the cheapest edits row by row, one list of edits kept
# per conversation and state (0 nothing yet, 1 system, 2 user, 3 assistant).
CONVERSATION_REPAIR = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hashed AS (
  SELECT *, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda z, y: xor(z >> 1, 3988292384::BIGINT * (z & 1))))) % 20 AS damage
  FROM keyed),
hurt AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN damage = 1 THEN '' WHEN damage = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE damage <> 0),
told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hurt)),
faulty AS (
  SELECT *, left(role, 1) AS ini,
         CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
              WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM told),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY conv_id),
put(state, word, mid, added) AS (VALUES
  (0, '', 0, ''), (0, 'I', 2, chr(10) || 'user:'), (0, 'II', 3, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, '', 1, ''), (1, 'I', 2, chr(10) || 'user:'), (1, 'II', 3, chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, '', 2, ''), (2, 'I', 3, chr(10) || 'assistant:'), (3, '', 3, ''), (3, 'I', 2, chr(10) || 'user:')),
moves AS (
  SELECT conv_id, i, state, word || letter AS word, 3 * len(word) + paid AS cost, "to",
         added || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text
           ELSE chr(10) || CASE "to" WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || text END AS added
  FROM (
    SELECT f.conv_id, f.i, f.role, f.text, p.state, p.word, p.added, l.letter,
           CASE l.letter WHEN 'D' THEN p.mid WHEN 'R' THEN CASE p.mid WHEN 2 THEN 3 ELSE 2 END
             ELSE CASE WHEN ini = 's' AND p.mid = 0 THEN 1 WHEN ini = 'u' AND p.mid <> 2 THEN 2
                       WHEN ini = 'a' AND p.mid = 2 THEN 3 END END AS "to",
           CASE l.letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
             + CASE WHEN fault = 'truncated' AND l.letter <> 'D' THEN 3 ELSE 0 END AS paid
    FROM faulty f, put p, (VALUES ('D'), ('K'), ('R')) l(letter)
    WHERE l.letter = 'D' OR fault NOT IN ('blank', 'duplicate'))
  WHERE "to" IS NOT NULL),
best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, '' AS made FROM counts
  UNION ALL
  SELECT conv_id, i, state, cost, audit, made FROM (
    SELECT b.conv_id, m.i, m."to" AS state, b.cost + m.cost AS cost, b.audit || m.word AS audit,
           b.made || m.added AS made
    FROM best b JOIN moves m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i + 1 AND m.state = b.state)
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
done AS (
  SELECT b.conv_id, b.cost + 3 * len(p.word) AS cost, b.audit || p.word AS audit, b.made || p.added AS made
  FROM best b JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i
  JOIN put p ON p.state = b.state AND (p.mid = 3 OR p.mid = 0)
  QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY b.cost + 3 * len(p.word), b.audit || p.word) = 1)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(made[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""

# Bytes as two hex digits each; windows are cut from slices of 600 bytes, since
# cutting them from a long text would walk it from its start.
SUFFIX_ARRAY_DEDUP = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
piece AS (
  SELECT rid, len(h) // 2 AS n, base, h[2 * base + 1:2 * base + 1200] AS part
  FROM (SELECT rid, h, unnest(generate_series(0, len(h) // 2 - 200, 400)) AS base FROM d)),
win AS (
  SELECT rid, base + o AS s, md5(part[2 * o + 1:2 * o + 400]) AS k
  FROM (SELECT rid, base, part, unnest(generate_series(0, least(399, n - 200 - base))) AS o FROM piece)),
hit AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
step AS (SELECT rid, s, s - lag(s) OVER (PARTITION BY rid ORDER BY s) <= 200 AS joined FROM hit),
run AS (
  SELECT rid, s, count(*) FILTER (joined IS NOT TRUE) OVER (PARTITION BY rid ORDER BY s) AS r FROM step),
span AS (SELECT rid, min(s) AS a, max(s) + 200 AS b FROM run GROUP BY rid, r),
gap AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS f FROM span),
cut AS (
  SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(h[2 * f + 1:2 * a], '' ORDER BY a) || any_value(h)[2 * max(b) + 1:] AS body
  FROM gap JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(body, h))) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)
"""

# Repeats of 3 and of 10 words by grouping windows; the longest repeat by
# doubling, then halving, over the positions whose windows still repeat.
QUALITY_RULES = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT rid, width, s, md5(array_to_string(words[s:s + width - 1], ' ')) AS k
  FROM (SELECT rid, words, width, unnest(generate_series(1, len(words) - width + 1)) AS s
        FROM d, (VALUES (3), (10)) w(width))),
hit AS (
  SELECT rid, width, s FROM (
    SELECT rid, width, s, count(*) OVER (PARTITION BY rid, width, k) AS n FROM win) WHERE n > 1),
cover AS (
  SELECT rid, sum(own) FILTER (width = 3) AS three, sum(own) FILTER (width = 10) AS ten
  FROM (SELECT rid, width,
               least(width, coalesce(lead(s) OVER (PARTITION BY rid, width ORDER BY s) - s, width)) AS own
        FROM hit) GROUP BY rid),
search AS (
  SELECT rid, unnest(generate_series(1, len(words))) AS s, 0::BIGINT AS lo, NULL::BIGINT AS hi FROM d
  UNION ALL
  SELECT rid, s, CASE WHEN twice THEN mid ELSE lo END, CASE WHEN twice THEN hi ELSE mid END
  FROM (
    SELECT *, bool_or(n > 1) OVER (PARTITION BY rid) AS twice
    FROM (
      SELECT *, CASE WHEN k IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY rid, k) END AS n
      FROM (
        SELECT rid, s, lo, hi, mid,
               CASE WHEN s + mid <= len(words) + 1 THEN md5(array_to_string(words[s:s + mid - 1], ' ')) END AS k
        FROM (SELECT *, CASE WHEN hi IS NULL THEN greatest(1, 2 * lo) ELSE (lo + hi) // 2 END AS mid
              FROM search WHERE hi IS NULL OR hi - lo > 1) JOIN d USING (rid))))
  WHERE n > 1 OR NOT twice),
longest AS (SELECT rid, max(lo) AS n FROM search GROUP BY rid),
told AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         CAST(coalesce(three, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(ten, 0) AS BIGINT) AS covered_words, coalesce(longest.n, 0) AS longest_repeat
  FROM d LEFT JOIN longest USING (rid) LEFT JOIN cover USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM told)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
       n_repeat_words, covered_words, longest_repeat, base_failed,
       NOT (base_failed OR 100 * covered_words > 30 * n_words
            OR (longest_repeat >= 10 AND 100 * longest_repeat > 20 * n_words)) AS kept
FROM judged
"""

ORACLE_SQL = {
    "op1_suffix_array_dedup": SUFFIX_ARRAY_DEDUP,
    "op2_url_filter": URL_FILTER,
    "op4_quality_rules": QUALITY_RULES,
    "op6_simhash_near_dedup": SIMHASH_NEAR_DEDUP,
    "op7_substring_dedup": SUBSTRING_DEDUP,
    "op11_source_divergence": SOURCE_DIVERGENCE,
    "op12_embedding_near_dedup": EMBEDDING_NEAR_DEDUP,
    "op13_conversation_repair": CONVERSATION_REPAIR,
}
