"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.mixing import DEFAULT_WEIGHTS, MAX_EPOCHS

OP10 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS ord
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) AS rnk
  FROM d GROUP BY source),
w AS (
  SELECT *, [{', '.join(f'{float(x)}::DOUBLE' for x in DEFAULT_WEIGHTS)}][((rnk - 1) % {len(DEFAULT_WEIGHTS)}) + 1] AS wt,
         CAST(source_size * {MAX_EPOCHS} AS DOUBLE) AS cap FROM s),
lv AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY cap / wt, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(wt) OVER ()
               - coalesce(sum(wt) OVER (ORDER BY cap / wt, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lvl
  FROM w),
t AS (SELECT *, least(cap, max(lvl) OVER () * wt) AS target FROM lv),
q AS (
  SELECT d.*, t.rnk, t.source_size, t.target,
         row_number() OVER (ORDER BY t.rnk, ord, size) AS rid,
         sum(size) OVER (PARTITION BY t.rnk ORDER BY ord, size ROWS UNBOUNDED PRECEDING) AS run
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT q.*, epoch, (epoch * source_size + run) / target AS finish
  FROM q, (SELECT unnest(range({MAX_EPOCHS})) AS epoch)
  WHERE epoch * source_size + run - size < target),
m AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rnk, ord, size, epoch ROWS UNBOUNDED PRECEDING) AS spent FROM e),
k AS (
  SELECT rid, sum(size) AS taken FROM m
  WHERE spent <= (SELECT sum(size) FROM d) GROUP BY rid)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM q LEFT JOIN k USING (rid)
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL),
counts AS (SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
totals AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM counts),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * all_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM df, totals),
m AS (SELECT rid, doc_id, 25 + (75 * n * all_docs) // all_terms AS m FROM counts, totals),
i AS (
  SELECT iid, item_id, term, count(*) AS qtf FROM (
    SELECT row_number() OVER () AS iid, item_id, unnest(
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY iid, item_id, term),
s AS (
  SELECT iid, item_id, rid, doc_id,
         CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN m USING (rid)
  GROUP BY iid, item_id, rid, doc_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id ASC NULLS LAST, rid) AS place
  FROM s WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM r WHERE place <= 10
"""

#: The repair as a shortest path through the grammar's automaton, turn by
#: turn: cheapest (cost, audit) per phase (0 nothing yet, 1 behind s, 2
#: behind u, 3 behind a), inserted turns between.
OP12 = r"""
WITH RECURSIVE
src AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k,
         row_number() OVER () AS rid FROM conversations),
kinds AS (
  SELECT conv_id, turn, rid, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)),
           lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)),
             lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 20 AS kind
  FROM src),
turns AS (
  SELECT conv_id, turn, rid, copy, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, (SELECT unnest([0, 1]) AS copy)
  WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, rid, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, rid, copy) AS nth,
         rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS body
  FROM turns),
judged AS (
  SELECT *, body = '' AS is_blank, body <> '' AND nth > 1 AS is_duplicate,
         body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS is_truncated,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count_if(is_blank) AS blank, count_if(is_duplicate) AS duplicate,
         count_if(is_truncated) AS truncated,
         count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
         max(i) AS n
  FROM judged GROUP BY conv_id),
steps AS (
  SELECT conv_id, i, initial, is_blank OR is_duplicate AS gone, is_truncated::BIGINT AS cut FROM judged),
paths AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, {'c': 0::BIGINT, 'a': ''} AS s0,
         {'c': 1000000000::BIGINT, 'a': ''} AS s1, {'c': 1000000000::BIGINT, 'a': ''} AS s2,
         {'c': 1000000000::BIGINT, 'a': ''} AS s3
  FROM steps
  UNION ALL
  SELECT conv_id, i, {'c': p0.c + 3, 'a': p0.a || 'D'},
    list_sort([{'c': p1.c + 3, 'a': p1.a || 'D'},
               {'c': p0.c + cut + CASE WHEN gone OR initial <> 's' THEN 1000000000 ELSE 0 END, 'a': p0.a || 'K'}])[1],
    list_sort([{'c': p2.c + 3, 'a': p2.a || 'D'}]
      || list_transform([p0, p1, p3], lambda p: {
           'c': p.c + cut + CASE WHEN gone THEN 1000000000 WHEN initial = 'u' THEN 0 ELSE 2 END,
           'a': p.a || CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END}))[1],
    list_sort([{'c': p3.c + 3, 'a': p3.a || 'D'},
               {'c': p2.c + cut + CASE WHEN gone THEN 1000000000 WHEN initial = 'a' THEN 0 ELSE 2 END,
                'a': p2.a || CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END}])[1]
  FROM (
    SELECT conv_id, s.i, s.initial, s.gone, s.cut, s0 AS p0, s1 AS p1, q2 AS p2,
           list_sort([s3, {'c': q2.c + 2, 'a': q2.a || 'I'}])[1] AS p3
    FROM (SELECT *, list_sort([s2] || list_transform([s0, s1, s3],
            lambda p: {'c': p.c + 2, 'a': p.a || 'I'}))[1] AS q2 FROM paths) q
    JOIN steps s USING (conv_id) WHERE s.i = q.i + 1)),
ends AS (
  SELECT conv_id, list_sort([s0, list_sort([s3, {'c': q2.c + 2, 'a': q2.a || 'I'}])[1]])[1] AS best
  FROM (SELECT *, list_sort([s2] || list_transform([s0, s1, s3],
          lambda p: {'c': p.c + 2, 'a': p.a || 'I'}))[1] AS q2 FROM paths) q JOIN figures f USING (conv_id)
  WHERE q.i = f.n),
letters AS (
  SELECT conv_id, unnest(string_split(best.a, '')) AS letter, unnest(range(1, len(best.a) + 1)) AS place
  FROM ends),
edits AS (
  SELECT *, count_if(letter <> 'I') OVER w AS i, count_if(letter <> 'D') OVER w AS j,
         count_if(letter <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY place)),
lines AS (
  SELECT e.conv_id, place,
         CASE WHEN letter = 'K' THEN role WHEN (j + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM edits e LEFT JOIN judged t ON t.conv_id = e.conv_id AND t.i = e.i
  WHERE letter <> 'D'),
repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS body FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures USING (conv_id) LEFT JOIN ends USING (conv_id) LEFT JOIN repaired USING (conv_id)
"""

ORACLE_SQL: dict[str, str] = {"op10_mixing": OP10, "op11_lexical_search": OP11,
                              "op12_conversation_repair": OP12}
