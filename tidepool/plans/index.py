"""Index and search queries over ``pages`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.config import IndexConfig
from tidepool.functions.text import WORD, WORD_OR_MARK
from tidepool.operators import index as ops
from tidepool.operators import sets
from tidepool.plans import Query, table
from tidepool.plans.crawl import quoted, text_sql
from tidepool.sources import index_files
from tidepool.storage import materialize, scratch_path

# Small shards, so that a test table already has several.
CFG = IndexConfig(docs_per_shard=100, block_bytes=50_000)
EXCLUDED_SQL = "(" + ", ".join(quoted(t) for t in CFG.excluded) + ")"
URL_ESCAPE = "replace(replace(replace(url, '%', '%25'), ';', '%3B'), ',', '%2C')"

DOCS_SQL = f"docs AS (SELECT page_id, url, {text_sql('html')} AS text FROM pages)"
TOKENS_SQL = f"""{DOCS_SQL},
  toks AS (SELECT page_id, url, unnest(regexp_extract_all(text, '{WORD}')) AS token FROM docs)"""
POSTINGS_SQL = f"""{TOKENS_SQL},
  postings AS (SELECT url, lower(token) AS term, count(*) AS tf FROM toks
               WHERE token NOT IN {EXCLUDED_SQL} GROUP BY url, lower(token))"""
SHARDED_SQL = f"""{POSTINGS_SQL},
  n AS (SELECT CAST(greatest(1, ceil(count(*) / 100.0)) AS BIGINT) AS shards FROM docs),
  sharded AS (SELECT p.*, CAST(CAST('0x' || substr(md5(url), 1, 7) AS BIGINT) % n.shards
                AS INTEGER) AS shard FROM postings p, n),
  idx AS (SELECT term, shard, CAST(sum(tf) AS BIGINT) AS freq, count(*) AS df,
            string_agg(url, ' ' ORDER BY url) AS postings,
            term || ';' || CAST(sum(tf) AS BIGINT) || ';' ||
              string_agg({URL_ESCAPE}, ',' ORDER BY url) AS line
          FROM sharded GROUP BY term, shard)"""
BLOCKS_SQL = f"""{SHARDED_SQL},
  blocked AS (SELECT url, CAST(floor(before / 50000) AS BIGINT) + 1 AS block FROM (
      SELECT url, coalesce(sum(strlen(text)) OVER (ORDER BY page_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM docs)),
  blocks AS (SELECT block, term, shard, CAST(sum(tf) AS BIGINT) AS freq, count(*) AS df,
               string_agg(url, ' ' ORDER BY url) AS postings,
               block || ';' || term || ';' || CAST(sum(tf) AS BIGINT) || ';' ||
                 string_agg({URL_ESCAPE}, ',' ORDER BY url) AS line
             FROM sharded JOIN blocked USING (url) GROUP BY block, term, shard)"""


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _docs(spark, sf, mode="text"):
    return ops.page_text(_pages(spark, sf), mode)


def _postings(spark, sf):
    return ops.document_index(_docs(spark, sf), CFG)


def _index(spark, sf):
    return ops.inverted_index(_postings(spark, sf), ops.shard_count(_pages(spark, sf), CFG))


def _blocks(spark, sf):
    pages = _pages(spark, sf)
    docs = pages.select("page_id", "url", ops.html_to_text("html").alias("text"))
    return ops.build_blocks(docs, "page_id", CFG, ops.shard_count(pages, CFG))


def _saved(spark, sf):
    """The postings as a searcher finds them: written once, sorted by term."""
    path = scratch_path(spark, "postings")
    ops.save_postings(_postings(spark, sf), path)
    return ops.open_postings(spark, path)


def _saved_index(spark, sf):
    path = scratch_path(spark, "index")
    index = _index(spark, sf)
    ops.save_index(index, path)
    return spark.read.schema(index.schema).parquet(path)


def _flat(df):
    return df.withColumn("postings", F.array_join("postings", " "))


def _token_counts(toks, name):
    return toks.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def tokenize(spark, sf):
    marks = IndexConfig(words_only=False)
    return _token_counts(ops.tokenize(_docs(spark, sf), marks), "token")


def exclude_tokens(spark, sf):
    marks = IndexConfig(words_only=False)
    return _token_counts(ops.exclude_tokens(ops.tokenize(_docs(spark, sf, "raw"), marks), marks),
                         "token")


def lowercase_terms(spark, sf):
    return _token_counts(ops.lowercase_terms(ops.tokenize(_docs(spark, sf), CFG)), "term")


def document_index(spark, sf):
    return _postings(spark, sf)


def inverted_index(spark, sf):
    return _flat(_index(spark, sf))


def term_stats(spark, sf):
    return ops.term_stats(_postings(spark, sf))


def document_terms(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("url"), "text")
    return ops.term_stats(ops.document_index(docs, CFG))


def index_raw_vs_text(spark, sf):
    out = None
    for mode in ("raw", "text"):
        stats = ops.term_stats(ops.document_index(_docs(spark, sf, mode), CFG))
        stats = stats.withColumn("mode", F.lit(mode))
        out = stats if out is None else out.unionByName(stats)
    return out


def build_blocks(spark, sf):
    return _flat(_blocks(spark, sf))


def merge_blocks(spark, sf):
    merged = ops.merge_blocks(_blocks(spark, sf), ops.shard_count(_pages(spark, sf), CFG))
    return _flat(merged)


def merge_totals(spark, sf):
    merged = ops.merge_blocks(_blocks(spark, sf), ops.shard_count(_pages(spark, sf), CFG))
    return merged.groupBy("term").agg(F.sum("freq").alias("freq"), F.sum("df").alias("df"))


def build_dictionary(spark, sf):
    return ops.build_dictionary(_index(spark, sf), CFG)


def search_term(spark, sf):
    return ops.search_term(_saved(spark, sf), "The")


def search_batch(spark, sf):
    words = ops.tokenize(table(spark, sf, "benchmark").select("text"), CFG)
    return ops.search_batch(_saved(spark, sf), words.select(F.col("token").alias("term")))


def search_json(spark, sf):
    return ops.search_json(_saved_index(spark, sf), ["the", "und", "que"])


def sort_terms(spark, sf):
    stats = ops.term_stats(_postings(spark, sf))
    return ops.sort_terms(stats.select("term"), "pos")


def write_block(spark, sf):
    path = scratch_path(spark, "blocks")
    index_files.write_blocks(_blocks(spark, sf), path, CFG)
    return spark.read.text(path).select(F.col("value").alias("line"))


def read_blocks(spark, sf):
    path = scratch_path(spark, "blocks")
    index_files.write_blocks(_blocks(spark, sf), path, CFG)
    return _flat(index_files.read_blocks(spark, path, CFG))


def write_index(spark, sf):
    path = scratch_path(spark, "index")
    index_files.write_index(_index(spark, sf), path, CFG)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _dictionary_file(spark, sf):
    path = scratch_path(spark, "dictionary")
    index_files.write_dictionary(ops.build_dictionary(_index(spark, sf), CFG), path)
    return path


def write_dictionary(spark, sf):
    return spark.read.text(_dictionary_file(spark, sf)).select(F.col("value").alias("line"))


def read_dictionary(spark, sf):
    return index_files.read_dictionary(spark, _dictionary_file(spark, sf))


def _bitmaps(spark, sf):
    postings = _saved(spark, sf)
    numbers = ops.number_urls(postings)
    return materialize(ops.term_bitmaps(postings, numbers), "bitmaps"), numbers


def set_union(spark, sf):
    return ops.search_any(_saved(spark, sf), ["and", "und"])


def set_intersection(spark, sf):
    bitmaps, numbers = _bitmaps(spark, sf)
    return ops.urls_of(ops.bits_of_all(bitmaps, ["the", "and"]), numbers)


def set_difference(spark, sf):
    bitmaps, numbers = _bitmaps(spark, sf)
    return ops.urls_of(ops.bits_without(bitmaps, "the", "and"), numbers)


def table_set_operations(spark, sf):
    postings = _saved(spark, sf)
    a = ops.search_term(postings, "the").select("url")
    b = ops.search_term(postings, "and").select("url")
    parts = {"union": sets.union(a, b), "intersection": sets.intersection(a, b),
             "difference": sets.difference(a, b)}
    out = None
    for name, df in parts.items():
        df = df.withColumn("op", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def subset_check(spark, sf):
    p = _saved(spark, sf)
    urls = _pages(spark, sf).select("url")
    the = ops.search_term(p, "the").select("url")
    und = ops.search_term(p, "und").select("url")
    checks = [("the_in_pages", sets.is_subset(the, urls)), ("pages_in_the", sets.is_subset(urls, the)),
              ("und_in_the", sets.is_subset(und, the)), ("pages_over_und", sets.is_superset(urls, und))]
    out = None
    for name, df in checks:
        df = df.select(F.lit(name).alias("test"), F.col("is_subset").alias("holds"))
        out = df if out is None else out.unionByName(df)
    return out


def _counts_sql(source: str, pattern: str, where: str, out: str, name: str) -> str:
    return f"""WITH toks AS (SELECT unnest(regexp_extract_all({source}, '{pattern}')) AS token
        FROM pages) SELECT {out} AS {name}, count(*) AS n FROM toks {where} GROUP BY 1"""


def _has(term: str) -> str:
    return f"(SELECT url FROM postings WHERE term = '{term}')"


QUERIES = {
    "tokenize": Query(tokenize, _counts_sql(text_sql("html"), WORD_OR_MARK, "", "token", "token")),
    "exclude_tokens": Query(exclude_tokens, _counts_sql(
        "html", WORD_OR_MARK, f"WHERE token NOT IN {EXCLUDED_SQL}", "token", "token")),
    "lowercase_terms": Query(lowercase_terms, _counts_sql(
        text_sql("html"), WORD, "", "lower(token)", "term")),
    "document_index": Query(document_index, f"WITH {POSTINGS_SQL} SELECT url, term, tf FROM postings"),
    "inverted_index": Query(inverted_index, f"""
        WITH {SHARDED_SQL} SELECT term, shard, freq, df, postings FROM idx"""),
    "term_stats": Query(term_stats, f"""
        WITH {POSTINGS_SQL} SELECT term, CAST(sum(tf) AS BIGINT) AS freq, count(*) AS df
        FROM postings GROUP BY term"""),
    "document_terms": Query(document_terms, f"""
        SELECT lower(token) AS term, count(*) AS freq, count(DISTINCT doc_id) AS df
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{WORD}')) AS token FROM documents)
        WHERE token NOT IN {EXCLUDED_SQL} GROUP BY 1"""),
    "index_raw_vs_text": Query(index_raw_vs_text, f"""
        WITH {DOCS_SQL}, toks AS (
          SELECT 'raw' AS mode, url, unnest(regexp_extract_all(html, '{WORD}')) AS token FROM pages
          UNION ALL
          SELECT 'text', url, unnest(regexp_extract_all(text, '{WORD}')) FROM docs)
        SELECT mode, lower(token) AS term, count(*) AS freq, count(DISTINCT url) AS df
        FROM toks WHERE token NOT IN {EXCLUDED_SQL} GROUP BY 1, 2"""),
    "build_blocks": Query(build_blocks, f"""
        WITH {BLOCKS_SQL} SELECT block, term, shard, freq, df, postings FROM blocks"""),
    "merge_blocks": Query(merge_blocks, f"""
        WITH {SHARDED_SQL} SELECT term, shard, freq, df, postings FROM idx"""),
    "merge_totals": Query(merge_totals, f"""
        WITH {POSTINGS_SQL} SELECT term, CAST(sum(tf) AS BIGINT) AS freq, count(*) AS df
        FROM postings GROUP BY term"""),
    "build_dictionary": Query(build_dictionary, f"""
        WITH {SHARDED_SQL}, placed AS (SELECT term, strlen(line) + 1 AS bytes,
          sum(strlen(line) + 1) OVER (ORDER BY term, shard) - strlen(line) - 1 AS before FROM idx)
        SELECT term, CAST(min(before) AS BIGINT) AS byte_offset,
          CAST(sum(bytes) AS BIGINT) AS byte_len FROM placed GROUP BY term"""),
    "search_term": Query(search_term, f"""
        WITH {POSTINGS_SQL} SELECT url, term, tf FROM postings WHERE term = 'the'"""),
    "search_batch": Query(search_batch, f"""
        WITH {POSTINGS_SQL}, wanted AS (SELECT DISTINCT lower(token) AS term FROM (
          SELECT unnest(regexp_extract_all(text, '{WORD}')) AS token FROM benchmark))
        SELECT term, url, tf FROM postings JOIN wanted USING (term)"""),
    "search_json": Query(search_json, f"""
        WITH {SHARDED_SQL} SELECT term, shard, '["' || replace(postings, ' ', '","') || '"]' AS json
        FROM idx WHERE term IN ('the', 'und', 'que')"""),
    "sort_terms": Query(sort_terms, f"""
        WITH {POSTINGS_SQL} SELECT term, row_number() OVER (ORDER BY term) - 1 AS pos
        FROM (SELECT DISTINCT term FROM postings)"""),
    "write_block": Query(write_block, f"WITH {BLOCKS_SQL} SELECT line FROM blocks"),
    "read_blocks": Query(read_blocks, f"""
        WITH {BLOCKS_SQL} SELECT block, term, freq, postings FROM blocks"""),
    "write_index": Query(write_index, f"WITH {SHARDED_SQL} SELECT line FROM idx"),
    "write_dictionary": Query(write_dictionary, f"""
        WITH {SHARDED_SQL}, placed AS (SELECT term,
          sum(strlen(line) + 1) OVER (ORDER BY term, shard) - strlen(line) - 1 AS before FROM idx)
        SELECT term || ' ' || CAST(min(before) AS BIGINT) AS line FROM placed GROUP BY term"""),
    "read_dictionary": Query(read_dictionary, f"""
        WITH {SHARDED_SQL}, placed AS (SELECT term,
          sum(strlen(line) + 1) OVER (ORDER BY term, shard) - strlen(line) - 1 AS before FROM idx)
        SELECT term, CAST(min(before) AS BIGINT) AS byte_offset FROM placed GROUP BY term"""),
    "set_union": Query(set_union, f"WITH {POSTINGS_SQL} {_has('and')} UNION {_has('und')}"),
    "set_intersection": Query(set_intersection,
                              f"WITH {POSTINGS_SQL} {_has('the')} INTERSECT {_has('and')}"),
    "set_difference": Query(set_difference,
                            f"WITH {POSTINGS_SQL} {_has('the')} EXCEPT {_has('and')}"),
    "table_set_operations": Query(table_set_operations, f"""
        WITH {POSTINGS_SQL}
        SELECT 'union' AS op, url FROM ({_has('the')} UNION {_has('and')})
        UNION ALL SELECT 'intersection', url FROM ({_has('the')} INTERSECT {_has('and')})
        UNION ALL SELECT 'difference', url FROM ({_has('the')} EXCEPT {_has('and')})"""),
    "subset_check": Query(subset_check, f"""
        WITH {POSTINGS_SQL}
        SELECT 'the_in_pages' AS test, NOT EXISTS({_has('the')} EXCEPT SELECT url FROM pages) AS holds
        UNION ALL SELECT 'pages_in_the', NOT EXISTS(SELECT url FROM pages EXCEPT {_has('the')})
        UNION ALL SELECT 'und_in_the', NOT EXISTS({_has('und')} EXCEPT {_has('the')})
        UNION ALL SELECT 'pages_over_und', NOT EXISTS({_has('und')} EXCEPT SELECT url FROM pages)"""),
}
