"""JSON, array and source-format queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions import arrays as A
from tidepool.functions import predicates as P
from tidepool.operators import nested as ops
from tidepool.functions.text import WORD
from tidepool.plans import Query, table
from tidepool.sources import csv_files, files, markup
from tidepool.storage import scratch_path


def _events(spark, sf):
    return table(spark, sf, "events")


def _turns(spark, sf):
    """Conversation turns as an array of (word, len) records."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.transform(
        words, lambda w: F.struct(w.alias("word"), F.length(w).cast("long").alias("len"))
    ).alias("items"))


def _words(items):
    return F.array_join(F.transform(items, lambda i: i["word"]), " ")


def json_path_extract(spark, sf):
    return ops.json_path(_events(spark, sf), "props", ["event_id"], ["k"])


def wildcard_values(spark, sf):
    return ops.wildcard_values(_events(spark, sf), "props", ["event_id"])


def recursive_find(spark, sf):
    nested = F.concat(F.lit('{"k": '), F.get_json_object("props", "$.k"), F.lit(', "in": {"type": "'),
                      F.col("event_type"), F.lit('", "list": [{"k": '), F.col("event_id"),
                      F.lit('}, {"z": {"k": '), F.col("user_id"), F.lit("}}]}}"))
    return ops.recursive_find(table(spark, sf, "events").withColumn("doc", nested), "doc", ["event_id"], "k")


def array_filter(spark, sf):
    kept = F.filter("items", lambda i: (i["len"] > 4) & i["word"].contains("e"))
    return _turns(spark, sf).select("conv_id", "turn", _words(kept).alias("words"))


def array_distinct_filter(spark, sf):
    kept = A.distinct_filter(F.col("items"), lambda i: i["len"] < 4)
    return _turns(spark, sf).select("conv_id", "turn", _words(kept).alias("words"))


def array_sort_by(spark, sf):
    ordered = A.sort_by(F.col("items"), [(lambda i: i["len"], True), (lambda i: i["word"], False)])
    return _turns(spark, sf).select("conv_id", "turn", _words(ordered).alias("words"))


def array_map(spark, sf):
    mapped = F.transform("items", lambda i: F.concat(F.upper(i["word"]), i["len"].cast("string")))
    return _turns(spark, sf).select("conv_id", "turn", F.array_join(mapped, " ").alias("words"))


def array_slice_step(spark, sf):
    items = F.col("items")
    return _turns(spark, sf).select(
        "conv_id", "turn", _words(A.slice_step(items, 2, 9, 3)).alias("fixed"),
        _words(A.slice_step(items, -4)).alias("tail"),
        _words(A.slice_step(items, 0, -2, 2)).alias("front"))


def pick_many(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", _words(
        A.pick_many(F.col("items"), [0, 2, 5])).alias("words"))


def ci_wildcard_compare(spark, sf):
    plain = F.filter("items", lambda i: P.wildcard(i["word"], "t*n"))
    fold = F.filter("items", lambda i: P.wildcard(i["word"], "T?e*", ignore_case=True))
    return _turns(spark, sf).select("conv_id", "turn", _words(plain).alias("plain"),
                                    _words(fold).alias("fold"))


def flatten_table(spark, sf):
    flat = ops.flatten_table(_turns(spark, sf), "items", ["conv_id", "turn"], ["word", "len"])
    return flat.groupBy("conv_id", "turn", "word", "len").agg(F.count(F.lit(1)).alias("n"))


def key_value_source(spark, sf):
    pairs = files.key_value_source(_events(spark, sf), "props", ["event_id"])
    return pairs.filter(P.wildcard("value", "*7*") & P.wildcard("key", "?"))


def csv_source(spark, sf):
    path = scratch_path(spark, "csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    csv_files.write_csv(docs, path, separator="|")
    back = csv_files.read_csv(spark, path, ["doc_id", "text", "lang"], separator="|")
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"),
                       "lang")


def csv_sink(spark, sf):
    path = scratch_path(spark, "csv")
    part = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit('"'), "c_mktsegment", F.lit('", '), "c_name").alias("label"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")).alias("nation"))
    csv_files.write_csv(part, path)
    return spark.read.text(path).filter("value <> 'c_custkey,label,nation'").select(
        F.col("value").alias("line"))


def html_table_extract(spark, sf):
    def cell(c):
        return F.concat(F.lit("<td>"), c, F.lit("</td>"))

    page = F.concat(
        F.lit('<html><table id="other"><tr><td>no</td></tr></table><TABLE class="x" id="turns">'
              "<tr><th>who</th><th>size &amp; id</th></tr><tr>"), cell(F.col("role")),
        cell(F.length("text").cast("string")), F.lit("</tr><tr>"), cell(F.col("turn").cast("string")),
        cell(F.col("conv_id").cast("string")), F.lit("</tr></TABLE></html>"))
    pages = table(spark, sf, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("url"), page.alias("html"))
    return markup.html_table_extract(pages, "turns")


def feed_outline_extract(spark, sf):
    xml = F.concat(
        F.lit('<opml><head><title>t</title></head><body><outline text="'), "event_type",
        F.lit('"><outline text="u'), F.col("user_id").cast("string"),
        F.lit('"><outline text="e"/></outline><outline text="last"/></outline>'),
        # every tenth document is cut off before its end
        F.when(F.col("event_id") % 10 == 3, F.lit("")).otherwise(F.lit("</body></opml>")))
    docs = table(spark, sf, "events").select("event_id", xml.alias("xml"))
    return markup.outline_items(docs, "event_id", "xml", errors=True)


_TURNS = """turns AS (SELECT conv_id, turn, list_transform(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+'),
  lambda w: {'word': w, 'len': CAST(length(w) AS BIGINT)}) AS items FROM conversations)"""


def _join(items: str) -> str:
    return f"coalesce(array_to_string(list_transform({items}, lambda i: i.word), ' '), '')"


def _turns_sql(**columns: str) -> str:
    cols = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"WITH {_TURNS} SELECT conv_id, turn, {cols} FROM turns"


QUERIES = {
    "json_path_extract": Query(json_path_extract, """
        SELECT event_id, '$[''k'']' AS path, json_extract_string(props, '$.k') AS value
        FROM events"""),
    "wildcard_values": Query(wildcard_values, """
        SELECT event_id, '$[''' || k || ''']' AS path, json_extract_string(props, '$.' || k) AS value
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)"""),
    "recursive_find": Query(recursive_find, """
        SELECT event_id, '$[''k'']' AS path, json_extract_string(props, '$.k') AS value FROM events
        UNION ALL SELECT event_id, '$[''in''][''list''][0][''k'']', CAST(event_id AS VARCHAR)
          FROM events
        UNION ALL SELECT event_id, '$[''in''][''list''][1][''z''][''k'']',
          CAST(user_id AS VARCHAR) FROM events"""),
    "array_filter": Query(array_filter, _turns_sql(words=_join(
        "list_filter(items, lambda i: i.len > 4 AND contains(i.word, 'e'))"))),
    "array_distinct_filter": Query(array_distinct_filter, f"""
        WITH {_TURNS}, k AS (SELECT conv_id, turn, items,
          list_filter(items, lambda i: i.len < 4) AS kept FROM turns)
        SELECT conv_id, turn, {_join('''list_filter(kept,
          lambda i, nr: list_position(kept, i) = nr)''')} AS words FROM k"""),
    "array_sort_by": Query(array_sort_by, _turns_sql(words="""
        coalesce(array_to_string(list_transform(list_sort(list_transform(items,
          lambda i: {'n': -i.len, 'w': i.word})), lambda i: i.w), ' '), '')""")),
    "array_map": Query(array_map, _turns_sql(words="""
        coalesce(array_to_string(list_transform(items,
          lambda i: replace(upper(i.word), 'ẞ', 'SS') || i.len), ' '), '')""")),
    "array_slice_step": Query(array_slice_step, _turns_sql(
        fixed=_join("list_filter(items, lambda i, nr: nr IN (3, 6, 9))"),
        tail=_join("items[greatest(len(items) - 3, 1):len(items)]"),
        front=_join("list_filter(items, lambda i, nr: nr % 2 = 1 AND nr <= len(items) - 2)"))),
    "pick_many": Query(pick_many, _turns_sql(words="""
        concat_ws(' ', items[1].word, items[3].word, items[6].word)""")),
    "ci_wildcard_compare": Query(ci_wildcard_compare, _turns_sql(
        plain=_join("list_filter(items, lambda i: i.word LIKE 't%n')"),
        fold=_join("list_filter(items, lambda i: i.word ILIKE 't_e%')"))),
    "flatten_table": Query(flatten_table, f"""
        WITH {_TURNS}, r AS (SELECT conv_id, turn, unnest(items) AS i FROM turns)
        SELECT conv_id, turn, i.word AS word, i.len AS len, count(*) AS n FROM r
        GROUP BY conv_id, turn, i.word, i.len"""),
    "key_value_source": Query(key_value_source, """
        SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events
        WHERE json_extract_string(props, '$.k') LIKE '%7%'"""),
    "csv_source": Query(csv_source, """
        SELECT doc_id, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS text_md5, lang
        FROM documents"""),
    "csv_sink": Query(csv_sink, "SELECT c_custkey || ',' || chr(34) || chr(34) || chr(34) || "
        "c_mktsegment || chr(34) || chr(34) || ', ' || c_name || chr(34) || ',' || coalesce(CASE "
        "WHEN c_nationkey > 4 THEN CAST(c_nationkey AS VARCHAR) END, '') AS line FROM customer"),
    "html_table_extract": Query(html_table_extract, """
        WITH c AS (SELECT conv_id || '-' || turn AS url, * FROM conversations)
        SELECT url, 0 AS row, 'who' AS heading, role AS value FROM c
        UNION ALL SELECT url, 0, 'size & id', CAST(length(text) AS VARCHAR) FROM c
        UNION ALL SELECT url, 1, 'who', CAST(turn AS VARCHAR) FROM c
        UNION ALL SELECT url, 1, 'size & id', CAST(conv_id AS VARCHAR) FROM c"""),
    "feed_outline_extract": Query(feed_outline_extract, """
        WITH good AS (SELECT * FROM events WHERE event_id % 10 <> 3)
        SELECT event_id, 0 AS item, CAST(NULL AS INTEGER) AS parent, 0 AS depth, event_type AS text,
          CAST(NULL AS VARCHAR) AS error FROM good
        UNION ALL SELECT event_id, 1, 0, 1, 'u' || user_id, NULL FROM good
        UNION ALL SELECT event_id, 2, 1, 2, 'e', NULL FROM good
        UNION ALL SELECT event_id, 3, 0, 1, 'last', NULL FROM good
        UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, 'not well formed' FROM events
          WHERE event_id % 10 = 3"""),
}
