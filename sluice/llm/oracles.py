"""DuckDB SQL for the training-data queries that SQL can express."""

OP2 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT rid, doc_id, list_distinct(CASE
           WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])
           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM docs
), held AS (
  SELECT rid, len(s) AS n, unnest(s) AS shingle FROM sets
), links AS (
  SELECT a.rid AS x, b.rid AS y
  FROM held a JOIN held b ON a.shingle = b.shingle AND a.rid <> b.rid
  GROUP BY a.rid, b.rid, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT rid, rid AS other FROM sets
  UNION
  SELECT r.rid, l.y FROM reach r JOIN links l ON l.x = r.other
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
FROM reach r JOIN sets s ON s.rid = r.rid JOIN sets o ON o.rid = r.other
GROUP BY s.rid, s.doc_id, len(s.s)
"""

OP10 = r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), pairs AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.rid <> c.rid AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""

OP11 = r"""
WITH tokens AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), docs AS (
  SELECT rid, doc_id, CAST(len(terms) AS BIGINT) AS n FROM tokens WHERE len(terms) > 0
), corpus AS (
  SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM docs
), held AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM tokens) GROUP BY ALL
), asked AS (
  SELECT DISTINCT iid, item_id, term FROM (
    SELECT iid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS iid, * FROM benchmark))
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * nn + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, nn
), scores AS (
  SELECT iid, item_id, rid, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN docs USING (rid), corpus
  WHERE doc_id IS NOT NULL
  GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

OP12 = r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), pairs AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, c.rid AS other, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.rid <> c.rid AND len(a.v) = len(c.v)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
), met AS (
  SELECT p.anchor, p.other, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN pairs n ON p.anchor = n.anchor AND NOT n.same
  WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM met WHERE rank <= 10
"""

OP13 = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), grams AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3)
), twice AS (
  SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1
), repeated AS (
  SELECT rid, count(*) AS n FROM (SELECT DISTINCT rid, i + unnest([0, 1, 2]) AS at FROM twice) GROUP BY rid
), base AS (
  SELECT s.*, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM split s LEFT JOIN repeated r USING (rid)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars BETWEEN 3 * n_words AND 10 * n_words
       AND 10 * n_symbols <= n_words
       AND 10 * n_dup_lines <= 3 * len(lines)
       AND 100 * len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) >= 80 * len(words)
       AND 10 * (length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g'))) <= 3 * word_chars
       AND 10 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) <= 3 * word_chars
       AND 100 * len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*\z'))) <= 30 * len(lines)
       AND 100 * len(list_filter(lines, lambda x: regexp_matches(x, '\A[\x20\x09-\x0D]*[-*•‣▪]'))) <= 90 * len(lines)
       AND len(list_filter(words, lambda x: length(x) > 1000)) = 0 AS kept
FROM judged
"""

ORACLE = {"op2_jaccard_join": OP2, "op10_top_k": OP10, "op11_lexical_search": OP11, "op12_hard_negatives": OP12, "op13_rule_cascade": OP13}
