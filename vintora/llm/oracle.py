"""SQL for the registered queries that SQL can express, over the same tables."""

from __future__ import annotations

LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACE_WORDS = r"regexp_extract_all({t}, '[^\x20\x09-\x0D]+')"

NGRAM_JOIN = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, {SPACE_WORDS.format(t=LOWER.format(t="coalesce(text, '')"))} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, s.v FROM reach r JOIN shared s ON s.u = r.other)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)"""

EMBEDDINGS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.v FROM reach r JOIN links l ON l.u = r.other),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)"""

WARC = """
WITH payloads AS (
  SELECT page_id, encode(coalesce(html, '')) AS p FROM pages),
digests AS (
  SELECT page_id, octet_length(p) AS n, sha1(p) AS h, min(page_id) OVER (PARTITION BY p) AS one FROM payloads),
bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    right('000' || bin(instr('0123456789abcdef', h[i]) - 1), 4)), '') AS b FROM digests)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + 16 * CAST(b[5 * i + 1] AS INTEGER) + 8 * CAST(b[5 * i + 2] AS INTEGER) + 4 * CAST(b[5 * i + 3] AS INTEGER)
      + 2 * CAST(b[5 * i + 4] AS INTEGER) + CAST(b[5 * i + 5] AS INTEGER) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = one THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> one THEN one END AS refers_to FROM bits"""

QUALITY_RULES = rf"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {SPACE_WORDS.format(t="coalesce(text, '')")} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + 4], ' ')) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows WHERE times > 1) GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, t, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM base LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
lines AS (
  SELECT DISTINCT source, t, regexp_replace(trim(l), ' +', ' ', 'g') AS l FROM (
    SELECT source, t, unnest(string_split(translate({LOWER.format(t="t")}, '123456789' || chr(9) || chr(11) || chr(12) || chr(13), '000000000    '), chr(10))) AS l
    FROM base) WHERE trim(l) <> ''),
texts AS (SELECT source, count(DISTINCT t) AS n_all FROM lines GROUP BY source),
template AS (
  SELECT source, l FROM lines JOIN texts USING (source) GROUP BY source, l, n_all
  HAVING count(*) > least(greatest(20, 0.01 * n_all), 1000)),
remain AS (
  SELECT lines.source, lines.t, sum(len(string_split(lines.l, ' '))) AS every,
    sum(CASE WHEN template.l IS NULL THEN len(string_split(lines.l, ' ')) ELSE 0 END) AS rest
  FROM lines LEFT JOIN template ON lines.source = template.source AND lines.l = template.l GROUP BY 1, 2)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rest < 0.2 * every, false) AS kept
FROM judged LEFT JOIN remain ON judged.source = remain.source AND judged.t = remain.t"""


HARD_NEGATIVES = """
WITH taking AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM taking a JOIN taking b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 5"""

TERMS = r"regexp_extract_all({t}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(t=LOWER.format(t="coalesce(text, '')"))

LEXICAL_SEARCH = f"""
WITH words AS (SELECT doc_id, {TERMS} AS w FROM documents),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM words),
frequency AS (
  SELECT doc_id, any_value(len(w)) AS n, t, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM words) GROUP BY doc_id, t),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * totals.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM frequency, totals GROUP BY t, totals.n),
items AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({TERMS}) AS t FROM benchmark) GROUP BY item_id, t),
impact AS (
  SELECT doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * f.n * totals.n) // totals.l)) AS v
  FROM frequency f, totals),
scored AS (
  SELECT item_id, doc_id, CAST(sum(c * w * v) AS BIGINT) AS score
  FROM items JOIN weight USING (t) JOIN impact USING (t) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20"""
