"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

SQL: dict[str, str] = {
    "op1_sharding": """
WITH crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n::BIGINT] || list_transform(range(8), lambda b: 0::BIGINT),
      lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS n))),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM documents, crc_table),
p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS first_byte,
    sum(size) OVER () AS total
  FROM d),
s AS (SELECT *, (first_byte * 16 // total)::INTEGER AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM s""",
    "op6_embeddings": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM v
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.x = v.vec_id) AS n_links,
  min(reach.y) AS component_id, v.vec_id = min(reach.y) AS kept
FROM v JOIN reach ON reach.x = v.vec_id GROUP BY v.vec_id""",
    "op8_mixing": f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS size,
    (('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, ''))[1:12])::BIGINT + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS position
  FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap, [3, 1, 2][position % 3 + 1] AS weight FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w WINDOW before AS (ORDER BY cap::DOUBLE / weight, position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level FROM l WHERE cap > level * weight ORDER BY cap::DOUBLE / weight, position LIMIT 1),
t AS (
  SELECT source, position, source_size,
    least(cap::DOUBLE, coalesce((SELECT level FROM f) * weight, cap::DOUBLE)) AS target
  FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
o AS (
  SELECT d.doc_id, d.size, d.source, d.u, r.source_size, r.target, floor(r.rate) AS whole, r.position,
    r.target - floor(r.rate) * r.source_size AS open, r.rate > floor(r.rate) AS sampled
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
z AS (
  SELECT position, size, any_value(open) AS open, count(*)::HUGEINT * size AS words,
    count(*)::HUGEINT * size * size AS squares
  FROM o WHERE sampled AND size > 0 GROUP BY position, size),
y AS (
  SELECT position, size,
    open - coalesce(sum(words) OVER (larger ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS left_open,
    sum(squares) OVER (larger ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS squares
  FROM z WINDOW larger AS (PARTITION BY position ORDER BY size DESC)),
b AS (
  SELECT position, arg_max(left_open / squares, size) AS by_size FROM y WHERE left_open * size <= squares GROUP BY position),
k AS (
  SELECT o.*, u / (1 - u) / CASE WHEN sampled AND by_size * size >= 1 THEN 'inf'::DOUBLE
      WHEN sampled AND by_size * size > 0 THEN by_size * size / (1 - by_size * size) END AS key
  FROM o LEFT JOIN b ON b.position = o.position),
c AS (
  SELECT *, whole::INTEGER + CASE WHEN key IS NOT NULL AND coalesce(sum(size) OVER (
      PARTITION BY position ORDER BY key NULLS LAST, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0::DOUBLE <= open THEN 1 ELSE 0 END AS copies
  FROM k)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken, source, copies FROM c""",
    "op10_exact_dedup": f"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)""",
    "op11_conversations": f"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n::BIGINT] || list_transform(range(8), lambda b: 0::BIGINT),
      lambda c, b: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS n))),
d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1]))) % 20 AS kind
  FROM conversations, crc_table),
e AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM d WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS tail, role[1:1] AS initial
  FROM e),
f AS (
  SELECT *, tail = '' AS blank,
    tail <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS repeated,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM o),
g AS (
  SELECT *, NOT blank AND NOT repeated AND tail NOT IN ('.', '!', '?') AS truncated FROM f),
step AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, [{{'q': 0, 'c': 0, 'a': ''}}] AS states FROM g
  UNION ALL
  SELECT conv_id, i, list_filter(list_transform([0, 1, 2, 3],
      lambda q: list_min(list_filter(moved, lambda s: s.q = q))), lambda s: s IS NOT NULL)
  FROM (
    SELECT conv_id, i, flatten(list_transform(opened, lambda s: CASE
        WHEN blank OR repeated THEN [{{'q': s.q, 'c': s.c + 4, 'a': s.a || 'D'}}]
        ELSE [{{'q': s.q, 'c': s.c + 4, 'a': s.a || 'D'}},
              {{'q': CASE s.q WHEN 2 THEN 3 ELSE 2 END, 'c': s.c + 3 + x, 'a': s.a || 'R'}}]
          || CASE WHEN initial = 's' AND s.q = 0 THEN [{{'q': 1, 'c': s.c + x, 'a': s.a || 'K'}}]
                  WHEN initial = 'u' AND s.q <> 2 THEN [{{'q': 2, 'c': s.c + x, 'a': s.a || 'K'}}]
                  WHEN initial = 'a' AND s.q = 2 THEN [{{'q': 3, 'c': s.c + x, 'a': s.a || 'K'}}]
                  ELSE [] END END)) AS moved
    FROM (
      SELECT g.conv_id, g.i, g.initial, g.blank, g.repeated, CASE WHEN g.truncated THEN 3 ELSE 0 END AS x,
        states || list_transform(states, lambda s:
            {{'q': CASE s.q WHEN 2 THEN 3 ELSE 2 END, 'c': s.c + 3, 'a': s.a || 'I'}})
          || list_transform(list_filter(states, lambda s: s.q < 2), lambda s:
            {{'q': 3, 'c': s.c + 6, 'a': s.a || 'II'}}) AS opened
      FROM step JOIN g ON g.conv_id IS NOT DISTINCT FROM step.conv_id AND g.i = step.i + 1))),
best AS (
  SELECT conv_id, list_min(flatten(list_transform(arg_max(states, i), lambda s: CASE s.q
      WHEN 2 THEN [{{'c': s.c + 3, 'a': s.a || 'I'}}] WHEN 1 THEN [{{'c': s.c + 6, 'a': s.a || 'II'}}]
      ELSE [{{'c': s.c, 'a': s.a}}] END))) AS w
  FROM step GROUP BY conv_id),
letters AS (
  SELECT conv_id, w.a[k] AS edit, k, len(regexp_replace(w.a[1:k], 'I', '', 'g')) AS i
  FROM (SELECT conv_id, w, unnest(range(1, len(w.a) + 1)) AS k FROM best)),
said AS (
  SELECT l.conv_id, l.edit, l.k, g.role, g.initial, CASE WHEN l.edit = 'I' THEN '' ELSE g.text END AS text
  FROM letters l LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM l.conv_id AND g.i = l.i AND l.edit <> 'I'
  WHERE l.edit <> 'D'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1
    - max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS place
  FROM said),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN place % 2 = 0 THEN 'user' ELSE 'assistant' END
    || ':' || text, chr(10) ORDER BY k) AS t
  FROM numbered GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (repeated) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM g GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.c, 0)::BIGINT AS cost,
  coalesce(w.a, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM a.conv_id""",
}
