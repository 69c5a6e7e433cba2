"""op1: line-first quality rules over all documents, and the SQL that checks them."""

from __future__ import annotations

from tidepool.llm import lines
from tidepool.llm.lines import BOILERPLATE, SEPARATORS, SPACE, SYMBOLS, WORD, LineRules, line_quality
from tidepool.plans import Query, table

DIGEST = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "base_failed", "kept", "n_lines", "n_clean_lines", "line_chars", "clean_chars"]


def op1_quality_rules(spark, sf):
    return line_quality(table(spark, sf, "documents")).select(*DIGEST)


def _sql(r: LineRules = LineRules()) -> str:
    separators = ", ".join(f"'{s}'" for s in SEPARATORS)
    trimmed, ends = ((chars.replace("'", "''")) for chars in (lines.BLANK + lines.CLOSING, lines.SENTENCE_ENDS))
    return f"""
WITH base AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT doc_id, rid, text,
    [w FOR w IN string_split_regex(text, '{SPACE}') IF w <> ''] AS words,
    [l FOR l IN string_split(text, chr(10)) IF regexp_matches(l, '{WORD}')] AS lines FROM base),
grams AS (
  SELECT rid, g.i AS i, array_to_string(words[g.i:g.i + {r.window - 1}], ' ') AS gram
  FROM parts, unnest(range(1, len(words) - {r.window - 2})) AS g(i)),
repeated AS (
  SELECT rid, count(*) AS n_repeat_words FROM (
    SELECT DISTINCT rid, i + k.k AS place
    FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams),
      (SELECT unnest(range(0, {r.window})) AS k) AS k
    WHERE n > 1) GROUP BY rid),
each_line AS (SELECT rid, unnest(lines) AS l FROM parts),
judged AS (
  SELECT rid, l, len([w FOR w IN string_split_regex(l, '{SPACE}') IF w <> '']) AS n,
    len([w FOR w IN string_split_regex(l, '{SPACE}') IF w IN ({separators})]) AS separators,
    length(l) - length(translate(l, '{SYMBOLS}', '')) AS symbols,
    (length(l) - length(replace(l, '!!', ''))) / 2 AS shouts
  FROM each_line),
line_sums AS (
  SELECT rid, count(*) AS n_lines, sum(length(l)) AS line_chars,
    count(*) FILTER (ok) AS n_clean_lines, coalesce(sum(length(l)) FILTER (ok), 0) AS clean_chars
  FROM (SELECT *, (n >= {r.short_line} OR rtrim(l, '{trimmed}') <> '' AND contains('{ends}', right(rtrim(l, '{trimmed}'), 1)))
      AND symbols * 100 <= length(l) * {r.symbol_percent}
      AND (shouts < 1 OR shouts * {r.shout_words} < n)
      AND (separators < 2 OR separators * {r.separator_words} < n)
      AND NOT regexp_matches(lower(l), '{'|'.join(BOILERPLATE)}') AS ok FROM judged) GROUP BY rid),
counted AS (
  SELECT p.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines,
    coalesce(n_clean_lines, 0)::BIGINT AS n_clean_lines,
    coalesce(line_chars, 0)::BIGINT AS line_chars,
    coalesce(clean_chars, 0)::BIGINT AS clean_chars
  FROM parts p LEFT JOIN repeated USING (rid) LEFT JOIN line_sums USING (rid))
SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words
    AS base_failed,
  NOT (n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words)
    AND (line_chars - clean_chars) * 100 <= line_chars * {r.max_lost_percent} AS kept
FROM counted"""


QUERIES = {"op1_quality_rules": Query(op1_quality_rules, _sql())}
