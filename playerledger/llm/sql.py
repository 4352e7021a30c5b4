"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

# Words, lines and three-word windows of every whole text.  RE2 and Spark agree
# on these patterns; chr(10) is the line end.
JUDGED = r"""
judged AS (
  SELECT doc_id, t, w, lines, len(w) AS n,
         list_filter(lines, lambda l: NOT (
           len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) > 0 AND (
             (length(l) - length(regexp_replace(l, '[|»›•]', '', 'g')) >= 2
              AND len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))
                  <= 4 * (length(l) - length(regexp_replace(l, '[|»›•]', '', 'g')) + 1))
             OR (len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) > 8
                 AND NOT regexp_matches(l, '[.!?:;,"'')\]»”’…。！？][\x20\x09-\x0D]*\z|[.!?…。！？][\x20\x09-\x0D]'))
             OR length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g'))
                > len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))
             OR (length(l) <= 200 AND regexp_matches(l, '(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|accept (all )?cookies|enable javascript|lorem ipsum|click here|skip to content|back to top)'))
           ))) AS good
  FROM (SELECT doc_id, coalesce(text, '') AS t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, n - 1)) AS i FROM judged WHERE n > 2)
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1)
  GROUP BY doc_id
), measured AS (
  SELECT j.*, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         n < 50 OR 100 * coalesce(r.n_repeat_words, 0) > 50 * n AS base_failed,
         list_sum(list_transform(lines, lambda l: length(l))) AS chars,
         coalesce(list_sum(list_transform(good, lambda l: length(l))), 0) AS left_chars
  FROM judged j LEFT JOIN repeated r USING (doc_id)
)"""

ORACLE_SQL["op2_quality_rules"] = "WITH " + JUDGED + r"""
SELECT doc_id, n::BIGINT AS n_words,
       coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
       (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
       (len(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))
        - len(list_distinct(list_filter(lines, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
       n_repeat_words, base_failed, len(lines)::BIGINT AS n_lines, (len(lines) - len(good))::BIGINT AS n_failed_lines,
       NOT base_failed AND (chars - left_chars) * 1000 <= chars * 400 AS kept
FROM measured"""

ORACLE_SQL["op6_line_dedup"] = r"""
WITH pages AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
), lines AS (
  SELECT DISTINCT r, source, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT r, source, unnest(lines) AS l FROM pages WHERE source IS NOT NULL)
), drops AS (
  SELECT source, list(k) AS keys
  FROM (SELECT source, k, count(*) AS n FROM lines WHERE k <> '' GROUP BY ALL)
  JOIN (SELECT source, count(*) AS pages FROM documents WHERE source IS NOT NULL GROUP BY source) USING (source)
  WHERE n >= 3 AND n > 0.1 * pages GROUP BY source
), cleaned AS (
  SELECT doc_id, source, lines, list_filter(lines, lambda l: NOT coalesce(list_contains(
           keys, trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), false)) AS good
  FROM pages LEFT JOIN drops USING (source)
)
SELECT doc_id, source, coalesce(len(lines), 0)::BIGINT AS n_lines,
       coalesce(len(lines) - len(good), 0)::BIGINT AS n_dropped, md5(array_to_string(good, chr(10))) AS clean_md5
FROM cleaned"""

# Exact Jaccard links over all pairs that share a shingle, then reachability.
ORACLE_SQL["op10_minhash_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(s) AS s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y
                    ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), groups AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM groups LEFT JOIN sizes USING (doc_id)"""

# All pairs of one label by cosine in doubles, then reachability.
ORACLE_SQL["op1_embedding_dedup"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), groups AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM groups LEFT JOIN degree USING (vec_id)"""

# Exact scores of the anchors against all rows (ids are unique in the table).
ORACLE_SQL["op13_hard_negatives"] = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM (SELECT * FROM q WHERE vec_id % 100 = 0) a JOIN q b ON a.vec_id <> b.vec_id OR a.label <> b.label
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
FROM positives JOIN (SELECT * FROM pairs WHERE NOT same) USING (anchor_id)
WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 10"""
