"""SQL twins of the native operators, for DuckDB."""

from __future__ import annotations

from tidewatch.llm import quality_rules as rules
from tidewatch.llm.common import ALNUM_WORD, BLANK_WORD
from tidewatch.llm.decontaminate import WINDOW
from tidewatch.llm.lexical_search import TOP


def quality_sql(table: str, keep: list[rules.Rule] = rules.RULES) -> str:
    """Measures and verdict of every row of `table` (doc_id, text)."""
    stops = ", ".join(f"'{form}'" for word in rules.STOP_WORDS for form in (word, word.capitalize()))
    checks = " AND ".join(f"({r.bottom} < {r.least} OR {r.top} / {r.bottom} BETWEEN {r.low} AND {r.high})" for r in keep)
    return f"""
WITH q_words AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{BLANK_WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{BLANK_WORD}')) AS lines FROM {table}
), q_windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + {rules.WINDOW - 1}], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {rules.WINDOW - 2})) AS i FROM q_words)
), q_twice AS (
  SELECT doc_id, g FROM q_windows GROUP BY doc_id, g HAVING count(*) > 1
), q_covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {rules.WINDOW})) AS p FROM q_windows JOIN q_twice USING (doc_id, g)) GROUP BY doc_id
), q_measures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '{rules.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
    len(list_filter(w, lambda x: x IN ({stops})))::BIGINT AS n_stop, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM q_words LEFT JOIN q_covered USING (doc_id)
), q_judged AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM q_measures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {checks} AS kept FROM q_judged"""


QUALITY_RULES = quality_sql("documents")


#: Words of letters and digits, A-Z lowered.
LOWERED_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ALNUM_WORD}')"


def contamination_sql(table: str) -> str:
    """Words, hits and items of every row of `table` (doc_id, text) against `benchmark`."""
    words = LOWERED_WORDS
    return f"""
WITH c_items AS (
  SELECT item_id, w, least(len(w), {WINDOW}) AS n FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0
), c_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM c_items)
), c_docs AS (
  SELECT doc_id, {words} AS w FROM {table}
), c_places AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM c_docs, (SELECT DISTINCT n FROM c_items))
), c_hits AS (
  SELECT doc_id, item_id, i, n FROM c_places JOIN c_windows USING (n, g)
), c_covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM c_hits) GROUP BY doc_id
), c_found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM c_hits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM c_docs LEFT JOIN c_covered USING (doc_id) LEFT JOIN c_found USING (doc_id)"""


CONTAMINATION = contamination_sql("documents")

#: The best documents of every row of `benchmark`.
LEXICAL_SEARCH = f"""
WITH s_docs AS (
  SELECT row_number() OVER () AS rid, doc_id, {LOWERED_WORDS} AS words FROM documents
), s_all AS (
  SELECT count(*) FILTER (len(words) > 0)::BIGINT AS docs, sum(len(words))::BIGINT AS terms FROM s_docs
), s_items AS (
  SELECT item_id, term, count(*) AS repeats FROM (SELECT item_id, unnest({LOWERED_WORDS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), s_counts AS (
  SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(words) AS n, unnest(words) AS term FROM s_docs)
  WHERE term IN (SELECT term FROM s_items) GROUP BY ALL
), s_weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM s_counts, s_all GROUP BY term, docs
), s_parts AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS part FROM s_counts JOIN s_weights USING (term), s_all
), s_scores AS (
  SELECT item_id, rid, doc_id, sum(repeats * part)::BIGINT AS score FROM s_items JOIN s_parts USING (term) GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, rid) AS rank FROM s_scores WHERE score > 0) WHERE rank <= {TOP}"""

#: Every node of the prefix trie of `conversations`; crc32 is spelled out bit by bit.
PREFIX_TRIE = """
WITH t_ids AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
), t_own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), t_built AS (
  SELECT a.conv_id AS c, list_concat(coalesce(b.s, [])[1 : h], a.s[h + 1 : len(a.s)]) AS s
  FROM t_own a JOIN t_ids USING (conv_id) LEFT JOIN t_own b ON b.conv_id = a.conv_id - a.conv_id % 5
), t_nodes AS (
  SELECT d, s[1 : d] AS p, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '') AS ends
  FROM (SELECT c, s, unnest(range(len(s) + 1)) AS d FROM t_built) GROUP BY d, s[1 : d]
), t_children AS (
  SELECT p[1 : d - 1] AS p, count(*) AS k FROM t_nodes WHERE d > 0 GROUP BY p[1 : d - 1]
), t_sized AS (
  SELECT t_nodes.*, coalesce(k, 0) AS k, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * strlen(p[d].t) END AS saved FROM t_nodes LEFT JOIN t_children USING (p)
), t_below AS (
  SELECT p[1 : u] AS p, sum(saved) AS saved, count(*) FILTER (k = 0) AS leaves FROM (SELECT *, unnest(range(d + 1)) AS u FROM t_sized) GROUP BY p[1 : u]
)
SELECT a.conv_id, a.d::BIGINT AS depth, b.conv_id AS parent_conv_id, a.n::BIGINT AS n_convs, a.k::BIGINT AS n_children, t_below.leaves::BIGINT AS n_leaves,
  t_below.saved::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM t_sized a JOIN t_below USING (p) LEFT JOIN t_nodes b ON a.d > 0 AND b.p = a.p[1 : a.d - 1] AND b.d = a.d - 1"""
