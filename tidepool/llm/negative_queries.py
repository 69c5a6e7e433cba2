"""op11: hard negatives for every hundredth vector, from all vectors, and the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.llm.hard_negatives import mine_hard_negatives
from tidepool.plans import Query, table

EVERY, SHIFTED, LABELS = 100, 7, 10


def op11_hard_negatives(spark, sf):
    label, key = F.col("label"), F.col("vec_id")
    relabel = F.when(key % SHIFTED == 0, (label + 1) % LABELS).otherwise(label)
    return mine_hard_negatives(table(spark, sf, "embeddings"), key % EVERY == 0, relabel)


SQL = f"""
WITH rows AS (
  SELECT *, row_number() OVER () AS rid, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM (
    SELECT DISTINCT vec_id, embedding,
      CASE WHEN vec_id % {SHIFTED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)),
scores AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % {EVERY} = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) <= 5),
mined AS (
  SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
    (row_number() OVER (PARTITION BY p.rid, positive_id ORDER BY n.score DESC, n.vec_id))::INT AS rank
  FROM positives p JOIN scores n ON n.rid = p.rid AND NOT n.same
    AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM mined WHERE rank <= 5"""

QUERIES = {"op11_hard_negatives": Query(op11_hard_negatives, SQL)}
