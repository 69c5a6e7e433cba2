"""op12: how far the sources of each language diverge, over all documents, and its SQL."""

from __future__ import annotations

from tidepool.llm.divergence import source_divergence
from tidepool.plans import Query, table


def op12_source_divergence(spark, sf):
    return source_divergence(table(spark, sf, "documents"))


SQL = r"""
WITH rows AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
terms AS (
  SELECT rid, lang, source,
    unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows),
counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n, count(DISTINCT rid) AS docs
  FROM terms GROUP BY lang, source, term),
kept AS (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, term HAVING sum(docs) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, counts.n FROM counts SEMI JOIN kept USING (lang, term)),
groups AS (
  SELECT lang, source, v, coalesce(total, 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM rows) LEFT JOIN (SELECT lang, v FROM langs) USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM found GROUP BY ALL) USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 5)) // (g.total + 5 * g.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (l.total + 5 * l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
  ON d.lang = a.lang AND d.source = a.source AND d.item = b.source)
SELECT lang, source, 'pair' AS part, item, value,
  (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', term, (p - q)::BIGINT,
  (row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term))::INT
FROM shares WHERE n > 0 AND p > q
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) <= 50"""

QUERIES = {"op12_source_divergence": Query(op12_source_divergence, SQL)}
