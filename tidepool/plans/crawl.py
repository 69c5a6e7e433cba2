"""Crawl queries over ``pages``."""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import functions as F

from tidepool.functions.text import (BLANKS, HIDDEN_STEPS, TAG_STEPS, decode_entities,
                                     encode_entities, html_to_text)
from tidepool.functions.urls import acceptable_path, host, in_scope, query_map, query_pairs
from tidepool.operators import crawl as ops
from tidepool.plans import Query, table

ROOTS = ["example.org", "example.net"]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The names of HTML 4 with the characters that the later standard gives them.
ENTITIES = {name: html5[f"{name};"] for name in name2codepoint}


def hidden_sql(column: str) -> str:
    for pattern, put in HIDDEN_STEPS:
        column = f"regexp_replace({column}, {quoted(pattern)}, {quoted(put)}, 'g')"
    return column


def entities_sql(column: str) -> str:
    """DuckDB form of decoding: every piece behind an ampersand by itself."""
    known = "MAP {" + ", ".join(f"{quoted(n)}: {quoted(c)}" for n, c in ENTITIES.items()) + "}"
    name = "regexp_extract(p, '^(#?[A-Za-z0-9]+);', 1)"
    code = (f"CASE WHEN regexp_matches({name}, '^#[0-9]{{1,7}}$') THEN TRY_CAST(substr({name}, 2) AS INTEGER)"
            f" WHEN regexp_matches({name}, '^#[xX][0-9A-Fa-f]{{1,6}}$')"
            f" THEN TRY_CAST('0x' || substr({name}, 3) AS INTEGER) END")
    char = (f"CASE WHEN starts_with({name}, '#') THEN CASE WHEN {code} BETWEEN 1 AND 1114111"
            f" AND {code} NOT BETWEEN 55296 AND 57343 THEN chr({code}) END ELSE ({known})[{name}] END")
    return (f"string_split({column}, '&')[1] || array_to_string([coalesce({char} ||"
            f" substr(p, length({name}) + 2), '&' || p) FOR p IN string_split({column}, '&')[2:]], '')")


def text_sql(column: str) -> str:
    """DuckDB form of the markup-to-text chain."""
    out = hidden_sql(column)
    for pattern, put in TAG_STEPS:
        out = f"regexp_replace({out}, {quoted(pattern)}, {quoted(put)}, 'g')"
    return f"trim(regexp_replace({entities_sql(out)}, {quoted(BLANKS)}, ' ', 'g'))"


LINKS_SQL = f"""
  links AS (
    SELECT src, dst FROM (
      SELECT url AS src,
           CASE WHEN ref LIKE '/%' THEN regexp_extract(url, '^([^:/]+://[^/?#]*)', 1) || ref
                ELSE ref END AS dst
      FROM (SELECT url, unnest(regexp_extract_all({hidden_sql("html")},
            '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*"([^"]*)"', 1)) AS ref FROM pages))
    WHERE regexp_matches(dst, '^https?://'))
"""
ACCEPT_SQL = """(strpos({u}, '#') = 0 AND regexp_extract({u}, '\\.([^./\\\\]*)$', 1) IN
  ('java','html','asp','js','properties','xml','jsp','sql',''))"""
SCOPE_SQL = "(contains({u}, 'example.org') OR contains({u}, 'example.net'))"


def accept(u: str) -> str:
    return ACCEPT_SQL.format(u=u)


def scope(u: str) -> str:
    return SCOPE_SQL.format(u=u)


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _seeds(spark, sf):
    return _pages(spark, sf).filter(in_scope("url", ROOTS)).select("url")


def scan_pages(spark, sf):
    fetched = ops.scan_pages(_seeds(spark, sf), _pages(spark, sf))
    return fetched.select("url", F.md5("html").alias("body_md5"), F.length("html").cast("long").alias("chars"))


def seed_source(spark, sf):
    sites = F.concat(F.lit("http://"), host("url"), F.lit("/"))
    return ops.seed_source(spark, _pages(spark, sf).select(sites.alias("url")))


def html_to_text_query(spark, sf):
    text = _pages(spark, sf).select("page_id", html_to_text("html").alias("text"))
    return text.select("page_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("chars"))


def extract_links(spark, sf):
    return ops.extract_links(_pages(spark, sf)).groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("n"))


def resolve_url(spark, sf):
    return ops.extract_links(_pages(spark, sf), ROOTS).select("src", "dst").distinct()


def in_scope_query(spark, sf):
    return _pages(spark, sf).select(
        "url", in_scope("url", ROOTS).alias("in_contains"),
        in_scope("url", ["example.org"], "host").alias("in_host"))


def acceptable_path_query(spark, sf):
    return _pages(spark, sf).select("url", acceptable_path("url").alias("acceptable"))


def not_visited(spark, sf):
    pages = _pages(spark, sf)
    links = ops.extract_links(pages).select(F.col("dst").alias("url")).filter(acceptable_path("url"))
    visited = pages.select("url").unionByName(
        ops.extract_links(pages.filter(in_scope("url", ["example.com"]))).select(
            F.col("dst").alias("url")))
    return ops.not_visited(links, visited)


def crawl_bfs(spark, sf):
    return ops.crawl_bfs(_pages(spark, sf), _seeds(spark, sf), ROOTS)


def crawl_rounds(spark, sf):
    """The star schema as a web site: regions link to nations, nations to customers, customers to
    orders, orders to suppliers and suppliers back to nations.  A page's links come in several rows."""
    def links(name, source, target):
        t = table(spark, sf, name)
        (a, ka), (b, kb) = source, target
        return t.select(
            F.concat(F.lit(f"http://shop.org/{a}/"), F.col(ka).cast("string")).alias("url"),
            F.concat(F.lit(f'<a href="../{b}/'), F.col(kb).cast("string"), F.lit('">')).alias("html"))

    pages = links("nation", ("region", "n_regionkey"), ("nation", "n_nationkey"))
    for name, source, target in [
            ("customer", ("nation", "c_nationkey"), ("customer", "c_custkey")),
            ("orders", ("customer", "o_custkey"), ("order", "o_orderkey")),
            ("lineitem", ("order", "l_orderkey"), ("supplier", "l_suppkey")),
            ("supplier", ("supplier", "s_suppkey"), ("nation", "s_nationkey"))]:
        pages = pages.unionByName(links(name, source, target))
    seeds = table(spark, sf, "region").filter("r_name = 'ASIA'").select(
        F.concat(F.lit("http://shop.org/region/"), F.col("r_regionkey").cast("string")).alias("url"))
    return ops.crawl_bfs(pages, seeds, ["shop.org"], scope="host")


def link_graph(spark, sf):
    return ops.link_graph(ops.extract_links(_pages(spark, sf)))


def preferred_merge(spark, sf):
    pages = _pages(spark, sf)
    found = ops.extract_links(pages).select(F.col("dst").alias("url"))
    return ops.preferred_merge(found, pages.select("url"))


def crawl_counters(spark, sf):
    return ops.crawl_counters(_pages(spark, sf))


def url_parts_and_query(spark, sf):
    pairs = _pages(spark, sf).select("page_id", F.posexplode(query_pairs("url")).alias("pos", "p"))
    return pairs.select("page_id", "pos", F.col("p.key").alias("key"),
                        F.col("p.value").alias("value"))


def query_values(spark, sf):
    values = _pages(spark, sf).select("page_id", F.explode(query_map("url")).alias("key", "values"))
    return values.select("page_id", "key", F.array_join("values", "|").alias("values"))


def html_entities(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text",
                                                encode_entities("text").alias("encoded"))
    return docs.select("doc_id", F.md5("encoded").alias("encoded_md5"),
                       F.md5(decode_entities("text")).alias("decoded_md5"),
                       (decode_entities("encoded") == F.col("text")).alias("round_trip"))


def _encode_sql(column: str) -> str:
    for name, char in sorted(ENTITIES.items(), key=lambda x: (x[0] != "amp", x[1])):
        column = f"replace({column}, {quoted(char)}, '&{name};')"
    return column


QUERIES = {
    "scan_pages": Query(scan_pages, f"""
        SELECT url, md5(html) AS body_md5, length(html) AS chars FROM pages
        WHERE {scope('url')}"""),
    "seed_source": Query(seed_source, """
        SELECT DISTINCT 'http://' || lower(regexp_extract(url, '^[^:/]+://([^/?#]*)', 1)) || '/'
          AS url, 0 AS depth FROM pages"""),
    "html_to_text": Query(html_to_text_query, f"""
        SELECT page_id, md5(text) AS text_md5, length(text) AS chars
        FROM (SELECT page_id, {text_sql('html')} AS text FROM pages)"""),
    "extract_links": Query(extract_links, f"""
        WITH {LINKS_SQL} SELECT src, dst, count(*) AS n FROM links GROUP BY src, dst"""),
    "resolve_url": Query(resolve_url, f"""
        WITH {LINKS_SQL} SELECT DISTINCT src, dst FROM links WHERE {scope('dst')}"""),
    "in_scope": Query(in_scope_query, f"""
        SELECT url, {scope('url')} AS in_contains,
          regexp_matches(lower(url), '^[^:/]+://([^/?#]*\\.)?example\\.org([/?#]|$)') AS in_host
        FROM pages"""),
    "acceptable_path": Query(acceptable_path_query, f"""
        SELECT url, {accept('url')} AS acceptable FROM pages"""),
    "not_visited": Query(not_visited, f"""
        WITH {LINKS_SQL} SELECT DISTINCT dst AS url FROM links WHERE {accept('dst')}
          AND dst NOT IN (SELECT url FROM pages)
          AND dst NOT IN (SELECT dst FROM links WHERE contains(src, 'example.com'))"""),
    "crawl_bfs": Query(crawl_bfs, f"""
        WITH RECURSIVE {LINKS_SQL},
        edges AS (SELECT DISTINCT src, dst FROM links WHERE {accept('dst')} AND {scope('dst')}),
        reach(url, depth) AS (
          SELECT url, 0 FROM pages WHERE {accept('url')} AND {scope('url')}
          UNION
          SELECT e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.url
          WHERE r.depth < 20)
        SELECT r.url, min(r.depth) AS depth,
          CASE WHEN r.url IN (SELECT url FROM pages) THEN 'fetched' ELSE 'missing' END AS status
        FROM reach r GROUP BY r.url"""),
    "crawl_rounds": Query(crawl_rounds, """
        WITH RECURSIVE edges AS (
          SELECT 'region/' || n_regionkey AS src, 'nation/' || n_nationkey AS dst FROM nation
          UNION SELECT 'nation/' || c_nationkey, 'customer/' || c_custkey FROM customer
          UNION SELECT 'customer/' || o_custkey, 'order/' || o_orderkey FROM orders
          UNION SELECT 'order/' || l_orderkey, 'supplier/' || l_suppkey FROM lineitem
          UNION SELECT 'supplier/' || s_suppkey, 'nation/' || s_nationkey FROM supplier),
        reach(page, depth) AS (
          SELECT 'region/' || r_regionkey, 0 FROM region WHERE r_name = 'ASIA'
          UNION SELECT e.dst, r.depth + 1 FROM reach r JOIN edges e ON e.src = r.page
          WHERE r.depth < 9)
        SELECT 'http://shop.org/' || page AS url, min(depth) AS depth,
          CASE WHEN page IN (SELECT src FROM edges) THEN 'fetched' ELSE 'missing' END AS status
        FROM reach GROUP BY page"""),
    "link_graph": Query(link_graph, f"""
        WITH {LINKS_SQL}, ends AS (SELECT src AS url, 1 AS o, 0 AS i FROM links
          UNION ALL SELECT dst, 0, 1 FROM links)
        SELECT url, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree
        FROM ends GROUP BY url"""),
    "preferred_merge": Query(preferred_merge, f"""
        WITH {LINKS_SQL}, merged AS (SELECT dst AS url, 0 AS priority FROM links
          UNION ALL SELECT url, 1 FROM pages)
        SELECT url, priority, row_number() OVER (ORDER BY priority, url) - 1 AS position
        FROM merged"""),
    "crawl_counters": Query(crawl_counters, f"""
        WITH {LINKS_SQL}
        SELECT 'pages' AS stage, count(*) AS processed FROM pages
        UNION ALL SELECT 'links', count(*) FROM links
        UNION ALL SELECT 'accepted', count(*) FROM links WHERE {accept('dst')}"""),
    "url_parts_and_query": Query(url_parts_and_query, """
        SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, split_part(part, '=', 1) AS key,
          url_decode(substr(part, length(split_part(part, '=', 1)) + 2)) AS value
        FROM (SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
              FROM (SELECT page_id, string_split(regexp_extract(url, '\\?([^#]*)', 1), '&') AS parts
                    FROM pages WHERE strpos(url, '?') > 0))
        WHERE part <> ''"""),
    "html_entities": Query(html_entities, f"""
        SELECT doc_id, md5({_encode_sql('text')}) AS encoded_md5,
          md5({entities_sql('text')}) AS decoded_md5, true AS round_trip
        FROM documents"""),
    "query_values": Query(query_values, """
        WITH parts AS (
          SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS pos
          FROM (SELECT page_id, string_split(regexp_extract(url, '\\?([^#]*)', 1), '&') AS parts
                FROM pages WHERE strpos(url, '?') > 0))
        SELECT page_id, split_part(part, '=', 1) AS key, string_agg(url_decode(
          substr(part, length(split_part(part, '=', 1)) + 2)), '|' ORDER BY pos) AS values
        FROM parts WHERE part <> '' GROUP BY page_id, split_part(part, '=', 1)"""),
}
