"""op7: documents sampled to raked source, language and topic weights, and the SQL that checks it."""

from __future__ import annotations

from tidepool.llm.mixing import DIMENSIONS, NONE, WORDS, MixSettings, mix_documents
from tidepool.plans import Query, table


def op7_mixing(spark, sf):
    return mix_documents(table(spark, sf, "documents"))


def mixing_sql(documents: str = "documents", s: MixSettings = MixSettings()) -> str:
    """The same rounds as nested common table expressions."""
    ctes = [f"""rows AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
    CASE WHEN n = 0 THEN 'empty'
      WHEN (n - length(regexp_replace(t, '[#*$%&]+', '', 'g'))) * 20 >= n THEN 'symbols'
      WHEN contains(t, ' | ') THEN 'lists' WHEN contains(t, '!!') THEN 'shouting'
      WHEN (n - length(regexp_replace(t, '[0-9]+', '', 'g'))) * 50 >= n THEN 'figures'
      WHEN n < 1000 THEN 'short prose' ELSE 'long prose' END AS topic,
    len(regexp_extract_all(t, '{WORDS}'))::BIGINT AS tokens
  FROM (SELECT *, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM {documents}))""",
            """cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens, 1::DOUBLE AS ratio
  FROM rows GROUP BY ALL)""",
            "total AS (SELECT sum(tokens)::DOUBLE AS total FROM cells)"]
    for d in DIMENSIONS:
        ctes.append(f"""target_{d} AS MATERIALIZED (
  SELECT {d}, p / sum(p) OVER () AS target FROM (
    SELECT {d}, pow(sum(tokens)::DOUBLE, {s.power(d)}) AS p FROM cells GROUP BY {d}
    HAVING sum(tokens) > 0))""")
    last = "cells"
    for k in range(s.rounds):
        for d in DIMENSIONS:
            name = f"fit_{k}_{d}"
            ctes.append(f"""{name} AS MATERIALIZED (
  SELECT source, lang, topic, tokens,
    ratio * coalesce(CASE WHEN now > 0 THEN target * total / now END, 1) AS ratio
  FROM (SELECT *, sum(tokens * ratio) OVER (PARTITION BY {d}) AS now FROM {last})
  LEFT JOIN target_{d} USING ({d}), total)""")
            last = name
    return f"""WITH {', '.join(ctes)}
SELECT * EXCLUDE (draw), copies > 0 AS kept FROM (
  SELECT *, floor(weight)::BIGINT + (draw < weight - floor(weight))::BIGINT AS copies
  FROM (SELECT doc_id, source, lang, topic, r.tokens, ratio, weight,
      ('0x' || substr(md5('{s.seed}:' || coalesce(doc_id::VARCHAR, '{NONE}')), 1, 13))::BIGINT
        / {float(16 ** 13)!r} AS draw
    FROM rows r JOIN (
      SELECT source, lang, topic, round(ratio, {s.digits}) AS ratio,
        CASE WHEN tokens > 0 THEN round(ratio, {s.digits}) * {s.share}::DOUBLE
          ELSE least(1, round(ratio, {s.digits}) * {s.share}::DOUBLE) END AS weight
      FROM {last}) USING (source, lang, topic)))"""


QUERIES = {"op7_mixing": Query(op7_mixing, mixing_sql())}
