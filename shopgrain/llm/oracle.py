"""SQL, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

from .license_scan import COMMENT, CUE, PARAGRAPH, SENTENCE, SENTENCE_END, THRESHOLD
from .license_templates import TOKEN, counts
from .oracle_conversations import OP11, OP13
from .url_graph import DAMPING, RULES, SEED_SHARE

#: Rounds of PageRank in SQL, which cannot tell when ranks stand still: enough for 10,000 hosts.
ROUNDS = 120

OP1 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id,
         row_number() OVER w AS place,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id ASC NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""

OP2 = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

OP3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT k, doc_id, t,
         regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM m)
), repeated AS (
  SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, w) > 1
), covered AS (
  SELECT k, count(DISTINCT i + o) AS n FROM repeated, (VALUES (0), (1), (2)) AS s(o) GROUP BY k
), f AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM m LEFT JOIN covered c USING (k)
), b AS (
  SELECT *, n_words < 50 AS r0, 100 * n_repeat_words > 50 * n_words AS r1,
         10 * n_symbols > n_words AS r2, 100 * n_dup_lines > 40 * n_lines AS r3,
         word_chars < 3 * n_words AS r4, word_chars > 10 * n_words AS r5
  FROM f
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       r0 OR r1 AS base_failed, NOT (r0 OR r1 OR r2 OR r3 OR r4 OR r5) AS kept, n_lines,
       (r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT)::BIGINT AS failed_bits
FROM b
"""


OP8 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT k, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
  FROM w
), n AS (
  SELECT k, count(*) AS n FROM s GROUP BY k
), links AS (
  SELECT p.a, p.b FROM (
    SELECT x.k AS a, y.k AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.k < y.k GROUP BY 1, 2
  ) p JOIN n na ON na.k = p.a JOIN n nb ON nb.k = p.b WHERE 100 * shared >= 75 * (na.n + nb.n - shared)
), ties AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(k, r) AS (
  SELECT k, k FROM w UNION SELECT reach.k, ties.b FROM reach JOIN ties ON reach.r = ties.a
), c AS (
  SELECT reach.k, min(t.doc_id) AS component_id FROM reach JOIN w t ON t.k = reach.r GROUP BY 1
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM w JOIN c USING (k) LEFT JOIN n USING (k)
"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else repr(v) for v in r) + ")" for r in rows)


# Patterns without what this engine's do not have: possessive repeats, and \\v among white space.
_BLANK = r"[ \t\n\x0B\f\r]+"
COMMENT_SQL = COMMENT.replace(r"[ \t]*+", r"[ \t]*").replace(")?+", ")?")
SENTENCE_END_SQL = SENTENCE_END.replace(r"\s+", _BLANK)

OP10 = rf"""
WITH known(template, licence, token, n) AS (VALUES {_values(counts())}),
d AS (
  SELECT doc_id, source || '/' || doc_id::VARCHAR AS path, text,
         regexp_matches(coalesce(text, ''), '{CUE}') AS cue FROM documents
), lines AS (
  SELECT DISTINCT doc_id, unnest(string_split(text, chr(10))) AS segment FROM d WHERE cue
), unwrapped AS (
  SELECT DISTINCT doc_id, regexp_replace(
    unnest(regexp_split_to_array(regexp_replace(text, '{COMMENT_SQL}', '', 'g'), '{PARAGRAPH}')), '{_BLANK}', ' ', 'g') AS segment
  FROM d WHERE cue
), segments AS (
  SELECT doc_id, unnest(regexp_split_to_array(text, '{PARAGRAPH}')) AS segment FROM d WHERE cue
  UNION SELECT * FROM lines
  UNION SELECT doc_id, unnest(regexp_extract_all(segment, '{SENTENCE}')) FROM lines WHERE regexp_matches(segment, '{CUE}')
  UNION SELECT doc_id, unnest(regexp_split_to_array(segment, '{SENTENCE_END_SQL}')) FROM unwrapped
    WHERE regexp_matches(segment, '{CUE}')
), s AS (
  SELECT * FROM segments WHERE regexp_matches(segment, '{CUE}')
), df AS (
  SELECT token, count(*) AS n_texts
  FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '{TOKEN}'))) AS token FROM documents) GROUP BY 1
), idf AS (
  SELECT token, ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + n_texts)) + 1.0 AS idf FROM df
), unseen AS (
  SELECT ln(1.0::DOUBLE + (SELECT count(*) FROM documents)) + 1.0 AS idf
), vector AS (
  SELECT template, licence, token, n * coalesce(idf.idf, unseen.idf) AS weight FROM known LEFT JOIN idf USING (token), unseen
), shares AS (
  SELECT template, licence, token, weight / sqrt(sum(weight * weight) OVER (PARTITION BY template)) AS share FROM vector
), terms AS (
  SELECT segment, token, count(*) * any_value(idf) AS weight
  FROM (SELECT segment, unnest(regexp_extract_all(lower(segment), '{TOKEN}')) AS token FROM (SELECT DISTINCT segment FROM s))
  JOIN idf USING (token) GROUP BY 1, 2
), dots AS (
  SELECT segment, template, licence, sum(weight * share) AS dot FROM terms JOIN shares USING (token) GROUP BY 1, 2, 3
), lengths AS (
  SELECT segment, sqrt(sum(weight * weight)) AS length FROM terms GROUP BY 1
), best AS (
  SELECT segment, licence, round(dot / length, 6) AS score FROM dots JOIN lengths USING (segment)
  QUALIFY row_number() OVER (PARTITION BY segment ORDER BY score DESC, licence DESC) = 1
), own AS (
  SELECT doc_id, licence, score FROM s JOIN best USING (segment) WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence DESC) = 1
)
SELECT doc_id, path, licence, score, CASE WHEN licence IS NOT NULL THEN 'own' END AS origin,
       NULL::VARCHAR AS licence_dir
FROM d LEFT JOIN own USING (doc_id)
"""


def _rounds(kind: str, seed: str, source: str, target: str) -> str:
    """Rounds of PageRank as successive tables; the last one is scaled to sum to one."""
    share = f"SELECT {source} AS h, {target} AS t, links / sum(links) OVER (PARTITION BY {source}) AS share FROM edges"
    parts = [
        f"{kind}_shares AS MATERIALIZED ({share})",
        f"{kind}0 AS MATERIALIZED (SELECT host AS h, 1.0::DOUBLE / count(*) OVER () AS r FROM hosts WHERE {seed} > {SEED_SHARE} * n)",
    ]
    for i in range(1, ROUNDS + 1):
        parts.append(
            f"""{kind}{i} AS MATERIALIZED (SELECT h, sum(r) AS r FROM (
      SELECT h, {1 - DAMPING} * r AS r FROM {kind}0
      UNION ALL SELECT t, {DAMPING} * r * share FROM {kind}{i - 1} JOIN {kind}_shares USING (h)) GROUP BY h)"""
        )
    parts.append(f"{kind} AS (SELECT h AS host, r / sum(r) OVER () AS rank FROM {kind}{ROUNDS})")
    return ",\n".join(parts)


_RULES = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)

OP5 = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
p AS (
  SELECT row_number() OVER () AS k, page_id, html, regexp_matches(coalesce(url, ''), '://') AS found,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', ['host', 'path']) AS u
  FROM pages
), h AS (
  SELECT k, page_id, html, translate(u.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, u.path AS path FROM p
), ruled AS (
  SELECT h.*, rule_host || rule_path AS rule, rule_verdict AS verdict FROM h LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY length(rule) DESC) = 1
), hosts AS MATERIALIZED (
  SELECT host, count(*) AS n, count(*) FILTER (WHERE verdict = 'allow') AS allowed,
         count(*) FILTER (WHERE verdict = 'block') AS blocked FROM ruled WHERE host <> '' GROUP BY host
), links AS (
  SELECT host AS a, translate(unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s>]+)', 1)),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b
  FROM ruled WHERE host <> ''
), edges AS MATERIALIZED (
  SELECT a, b, count(*)::DOUBLE AS links FROM links WHERE a <> b GROUP BY 1, 2
),
{_rounds("trust", "allowed", "a", "b")},
{_rounds("distrust", "blocked", "b", "a")},
known AS (
  SELECT count(*) AS n FROM (SELECT host FROM hosts UNION SELECT b FROM edges)
)
SELECT page_id, host, path, rule, coalesce(verdict,
  CASE WHEN coalesce(distrust.rank, 0) > coalesce(trust.rank, 0) AND coalesce(distrust.rank, 0) * known.n >= 1
       THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN trust USING (host) LEFT JOIN distrust USING (host), known
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1,
        "op2_warc": OP2,
        "op3_quality_rules": OP3,
        "op5_url_filters": OP5,
        "op8_minhash_near_dedup": OP8,
        "op10_license_scan": OP10,
        "op11_conversation_repair": OP11,
        "op13_conversation_trie": OP13,
    }
