"""op13: repeated windows of 35 words removed from all documents, and the SQL that checks it."""

from __future__ import annotations

from tidepool.llm.cover_repeats import CoverSettings, window_digest
from tidepool.plans import Query, table

WINDOW = 35


def op13_cover_anchors(spark, sf):
    return window_digest(table(spark, sf, "documents"), CoverSettings(window=WINDOW))


SQL = rf"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS rid,
    [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words
  FROM documents),
windows AS (
  SELECT rid, i.i AS i, md5(array_to_string(words[i.i:i.i + {WINDOW - 1}], ' ')) AS w
  FROM texts, unnest(range(1, len(words) - {WINDOW - 2})) AS i(i)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY w) AS n FROM windows)
  WHERE n > 1),
gone AS (SELECT DISTINCT rid, i + k.k AS i
  FROM again, (SELECT unnest(range(0, {WINDOW})) AS k) AS k),
each_word AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM texts),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM each_word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (rid)"""

QUERIES = {"op13_cover_anchors": Query(op13_cover_anchors, SQL)}
