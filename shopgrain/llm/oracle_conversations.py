"""SQL, for DuckDB, of the queries over conversations."""

from __future__ import annotations

#: Checksums of the texts in `keys(key)`, all ASCII.
CRC = r"""
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), checked AS (
  SELECT key, xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda s: ascii(s)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM keys, crc_table
)"""

OP11 = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations
), keys AS (SELECT DISTINCT key FROM raw), {CRC},
damaged AS (
  SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
         CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM raw JOIN checked USING (key), unnest(range(CASE WHEN crc % 20 = 3 THEN 2 ELSE 1 END))
  WHERE crc % 20 <> 0
), ids AS (
  SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
), placed AS (
  SELECT c, turn, role, text, left(role, 1) AS initial,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i
  FROM damaged d JOIN ids ON d.conv_id IS NOT DISTINCT FROM ids.conv_id
), judged AS (
  SELECT *, body = '' AS blank,
         body <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS duplicate,
         lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair
  FROM placed
), turns AS (
  SELECT *, blank OR duplicate AS must_go, NOT blank AND NOT duplicate AND right(body, 1) NOT IN ('.', '!', '?') AS cut
  FROM judged
), counts AS (
  SELECT c, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         count(*) FILTER (cut) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY c
), inserts(state, n, here, lines) AS (
  VALUES ('', 0, '', []::VARCHAR[]), ('', 1, 'u', ['user:']), ('', 2, 'a', ['user:', 'assistant:']),
         ('s', 0, 's', []), ('s', 1, 'u', ['user:']), ('s', 2, 'a', ['user:', 'assistant:']),
         ('u', 0, 'u', []), ('u', 1, 'a', ['assistant:']), ('u', 2, 'u', ['assistant:', 'user:']),
         ('a', 0, 'a', []), ('a', 1, 'u', ['user:']), ('a', 2, 'a', ['user:', 'assistant:'])
), actions(letter) AS (VALUES ('D'), ('K'), ('R')),
best AS (
  SELECT c, 0::BIGINT AS i, '' AS state, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS way FROM ids
  UNION ALL
  SELECT c, i, state, min(way) FROM (
    SELECT b.c, t.i,
      CASE letter WHEN 'D' THEN here WHEN 'K' THEN initial ELSE CASE here WHEN 'u' THEN 'a' ELSE 'u' END END AS state,
      {{'cost': way.cost + 2 * n + CASE letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 + cut::INT ELSE cut::INT END,
       'audit': way.audit || repeat('I', n) || letter,
       'lines': way.lines || s.lines || CASE letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [role || ':' || text]
         ELSE [CASE here WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text] END}} AS way
    FROM best b JOIN turns t ON t.c = b.c AND t.i = b.i + 1 JOIN inserts s USING (state), actions
    WHERE letter = 'D' OR NOT must_go AND (letter = 'R'
      OR here || initial IN ('s', 'u', 'su', 'ua', 'au') AND initial <> '')
  ) GROUP BY c, i, state
), ended AS (
  SELECT c, min({{'cost': way.cost + 2 * s.n, 'audit': way.audit || repeat('I', s.n), 'lines': way.lines || s.lines}}) AS way
  FROM best JOIN inserts s USING (state) LEFT JOIN counts USING (c)
  WHERE i = coalesce(counts.n, 0) AND here IN ('', 'a') GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, way.cost::BIGINT AS cost,
       way.audit AS audit, sha256(array_to_string(way.lines, chr(10))) AS repaired_sha256
FROM ids JOIN ended USING (c) LEFT JOIN counts USING (c)
"""

OP13 = rf"""
WITH turns AS (
  SELECT conv_id, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS token,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), keys AS (SELECT DISTINCT conv_id::VARCHAR AS key FROM turns), {CRC},
ids AS (
  SELECT key::BIGINT AS c, crc % 4 AS h, key::BIGINT - ((key::BIGINT % 20) + 20) % 20 AS base FROM checked
), rebuilt AS (
  SELECT c, k, token, words FROM ids JOIN turns ON conv_id = base WHERE k <= h
  UNION ALL SELECT c, k, token, words FROM ids JOIN turns ON conv_id = c WHERE k > h
), seqs AS (
  SELECT c, coalesce(list(token ORDER BY k) FILTER (token IS NOT NULL), []) AS tokens,
         coalesce(list(words ORDER BY k) FILTER (token IS NOT NULL), []) AS words
  FROM ids LEFT JOIN rebuilt USING (c) GROUP BY c
), nodes AS (
  SELECT tokens[1:d] AS path, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(any_value(words[d]), 0) * (count(*) - 1) AS saved,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(tokens) = d), '')) AS ends_sha256
  FROM seqs, unnest(range(0, len(tokens) + 1)) AS x(d) GROUP BY 1, 2
), children AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), sums AS (
  SELECT n.path[1:d] AS path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM nodes n LEFT JOIN children USING (path), unnest(range(0, depth + 1)) AS x(d) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves, saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""
