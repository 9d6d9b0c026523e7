"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from sedimenta.llm import decontaminate as c
from sedimenta.llm import embedding_duplicates as d
from sedimenta.llm import quality_rules as q

BLANK = r"[\x20\x09-\x0D]"


def _rule_sql(rule: q.Rule) -> str:
    ratio = f"(CAST({rule.top} AS DOUBLE) / greatest({rule.bottom}, 1))"
    parts = [f"{ratio} < {rule.low!r}"] * (rule.low is not None) + [f"{ratio} > {rule.high!r}"] * (rule.high is not None)
    return " OR ".join(parts)


QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(text, '{BLANK}+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS rows
  FROM d),
win AS (
  SELECT rid, i, array_to_string(words[i:i + {q.WINDOW - 1}], ' ') AS g
  FROM (SELECT rid, words, unnest(range(1, len(words) - {q.WINDOW - 2})) AS i FROM w WHERE len(words) >= {q.WINDOW})),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
rep AS (
  SELECT rid, sum(least({q.WINDOW}, coalesce(nxt - i, {q.WINDOW}))) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup) GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(rows) - len(list_distinct(rows)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(regexp_replace(text, '\\P{{L}}', '', 'g')) AS BIGINT) AS n_letters,
    CAST(length(regexp_replace(text, '\\P{{Lu}}', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in q.STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
    CAST(len(rows) AS BIGINT) AS n_lines,
    CAST(len(list_filter(rows, lambda x: regexp_matches(x, '^{BLANK}*[-*•]'))) AS BIGINT) AS n_bullet_lines,
    CAST(len(list_filter(rows, lambda x: regexp_matches(x, '(\\.\\.\\.|…){BLANK}*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM w LEFT JOIN rep USING (rid)),
j AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEATED_PERCENT} * n_words AS base_failed,
    concat_ws(',', {", ".join(f"CASE WHEN {_rule_sql(r)} THEN '{r.name}' END" for r in q.RULES)}) AS failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed = '' AS kept, failed
FROM j
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PLAIN_WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {PLAIN_WORDS} AS words FROM documents),
b AS (SELECT item_id, {PLAIN_WORDS} AS words FROM benchmark),
w AS (
  SELECT DISTINCT item_id, least(len(words), {c.N}) AS n, array_to_string(words[i:i + {c.N - 1}], ' ') AS g
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - {c.N - 2}, 2))) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM w),
g AS (
  SELECT rid, n, i, array_to_string(words[i:i + n - 1], ' ') AS g
  FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes WHERE len(words) >= n)),
hit AS (SELECT rid, i, g.n, item_id FROM g JOIN w ON g.g = w.g AND g.n = w.n),
places AS (SELECT DISTINCT rid, unnest(range(i, i + n)) AS at FROM hit),
covered AS (SELECT rid, count(*) AS n_hit FROM places GROUP BY rid),
found AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {c.SHARE} * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid)
"""

#: Whole-number products below 2^53 are exact as doubles.
HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.parts, b.parts) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""

EMBEDDING_DUPLICATES = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
links AS (
  SELECT a.rid AS a, b.rid AS b, b.vec_id AS id
  FROM (SELECT * FROM v WHERE usable) a JOIN (SELECT * FROM v WHERE usable) b ON a.label = b.label AND a.rid <> b.rid
  WHERE list_cosine_similarity(a.e, b.e) >= {d.COSINE!r}),
reach AS (
  SELECT rid, rid AS at, vec_id AS id FROM v
  UNION SELECT reach.rid, links.b, links.id FROM reach JOIN links ON reach.at = links.a),
least AS (SELECT rid, min(id) AS component_id FROM reach GROUP BY rid),
counted AS (SELECT a AS rid, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (rid) LEFT JOIN counted USING (rid)
"""

ORACLES = {
    "op8_quality_rules": QUALITY,
    "op10_decontaminate": CONTAMINATION,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_embedding_duplicates": EMBEDDING_DUPLICATES,
}
