"""SQL that gives the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op1_topk_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Base 32 takes the digest's 40 hexadecimal digits in groups of five: twenty bits, four letters.
ORACLE["op4_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
),
d AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS h,
         max(page_id) OVER (PARTITION BY body) AS top
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, CAST(i // 4 AS INTEGER) * 5 + 1, 5) AS BIGINT)
             >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER) + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""

_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _count(text: str, chars: str) -> str:
    return f"(length({text}) - length(translate({text}, '{chars}', '')))"


_LINE_WORDS, _LINE_INK = _WORDS.format("line"), "length(array_to_string({0}, ''))"
_BOILERPLATE = (
    "all rights reserved|licensed under|released under the|terms of use|terms of service|"
    "privacy policy|cookie|javascript|lorem ipsum|copyright|subscribe to|sign up for|click here|"
    "read more|share this"
)

ORACLE["op10_quality"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body,
         {_WORDS.format("coalesce(text, '')")} AS words
  FROM documents
),
windows AS (
  SELECT r, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 9)
),
again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
),
repeated AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM again) GROUP BY r
),
lines AS (
  SELECT r, line, {_LINE_INK.format(_LINE_WORDS)} AS ink, {_LINE_WORDS} AS lw,
         {_count('line', '|»›•·')} AS menu, {_count('line', '#*$%&|<>')} AS symbols,
         {_count('line', '!')} AS loud
  FROM (SELECT r, unnest(string_split(body, chr(10))) AS line FROM d)
),
judged AS (
  SELECT *, CASE
      WHEN menu >= 3 AND menu * 40 >= ink THEN 'navigation'
      WHEN symbols * 100 > ink * 10 THEN 'punctuation'
      WHEN loud >= 4 AND loud * 20 >= ink THEN 'punctuation'
      WHEN NOT regexp_matches(line, '[\p{{L}}\p{{N}}]') THEN 'punctuation'
      WHEN ink <= 200 AND regexp_matches(lower(line), '{_BOILERPLATE}') THEN 'boilerplate'
      WHEN len(lw) >= 10 AND len(list_distinct(lw)) * 100 <= len(lw) * 25
        AND len(list_filter(range(1, len(lw)), lambda i: lw[i] = lw[i + 1])) * 100 >= len(lw) * 50 THEN 'stutter'
    END AS rule
  FROM lines WHERE ink > 0
),
kept_lines AS (
  SELECT r, sum(ink) AS clean_chars
  FROM (SELECT DISTINCT r, line, ink FROM judged WHERE rule IS NULL) GROUP BY r
),
dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM judged GROUP BY r
),
counted AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST({_LINE_INK.format('words')} AS BIGINT) AS word_chars,
         CAST({_count('body', '#*$%&|<>')} AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(clean_chars, 0) AS BIGINT) AS clean_chars
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN dups USING (r) LEFT JOIN kept_lines USING (r)
),
based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT *, NOT base_failed AND clean_chars * 100 >= word_chars * 50 AS kept FROM based
"""

# Terms of a text: only A-Z is lower-cased, letters beyond ASCII are kept as they are.
_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

ORACLE["op11_decontamination"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents
),
items AS (SELECT item_id, {_TERMS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS m,
         array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)
),
places AS (
  SELECT r, i, m, array_to_string(words[i:i + m - 1], ' ') AS w
  FROM (SELECT r, words, m, unnest(range(1, len(words) - m + 2)) AS i
        FROM d, (SELECT DISTINCT m FROM windows) WHERE len(words) >= m)
),
hits AS (SELECT r, i, m, item_id FROM places JOIN windows USING (m, w)),
marked AS (
  SELECT r, count(DISTINCT word_at) AS n_hit
  FROM (SELECT r, unnest(range(i, i + m)) AS word_at FROM hits) GROUP BY r
),
named AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN named USING (r)
"""

ORACLE["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives JOIN pairs USING (anchor_id)
  WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE["op13_lexical"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents
),
totals AS (
  SELECT CAST(count(*) AS HUGEINT) AS n_docs, CAST(sum(len(words)) AS HUGEINT) AS total FROM d WHERE len(words) > 0
),
asked AS (
  SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)
),
counts AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
),
normed AS (
  SELECT r, doc_id, CAST(100 - 50 + ((50 * len(words) * n_docs) // total) AS BIGINT) AS m FROM d, totals
),
scored AS (
  SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN normed USING (r)
  GROUP BY item_id, r
),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored JOIN normed USING (r) WHERE score > 0 AND doc_id IS NOT NULL
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
