"""Record queries: predicates, sorting, paging, joins, dates and arrays."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidepool.functions import arrays, dates
from tidepool.functions import predicates as P
from tidepool.functions.dates import epoch_us
from tidepool.operators import records as ops
from tidepool.operators.hierarchy import tree_flatten as flatten
from tidepool.operators.joins import interval_overlap_join as overlap_join
from tidepool.operators.joins import query_by_example_join as example_join
from tidepool.operators.ordered import row_numbers
from tidepool.functions.text import WORD
from tidepool.plans import Query, table


def _t(name):
    return lambda spark, sf: table(spark, sf, name)


orders, customer, events, documents, conversations, supplier = (
    _t(n) for n in ("orders", "customer", "events", "documents", "conversations", "supplier"))

NAMED = {"large": lambda df: (df["o_totalprice"] > 250_000) & (df["o_orderstatus"] != "P")}
RANKS = {"5-LOW": 1, "1-URGENT": 2, "3-MEDIUM": 3}


def match_filter(spark, sf):
    query = {"o_orderstatus": "F", "o_orderpriority": re.compile("^[12]-"),
             "o_totalprice": lambda c: c > 100_000}
    return ops.where(orders(spark, sf), query).select("o_orderkey", "o_orderpriority")


def named_filter(spark, sf):
    return ops.where(orders(spark, sf), "large", NAMED).select("o_orderkey", "o_totalprice")


def wildcard_match(spark, sf):
    return customer(spark, sf).select(
        "c_custkey",
        P.wildcard("c_name", "Customer#*7?").alias("seven"),
        P.wildcard("c_mktsegment", "*u?n*", ignore_case=True).alias("ci"),
        P.wildcard("c_mktsegment", "*u?n*").alias("cs"),
        P.wildcard("c_name", "Customer\\#00000000?").alias("escaped"))


def bool_filter(spark, sf):
    words = F.split("text", r"\s+")
    docs = documents(spark, sf).withColumn("words", words)
    cond = P.any_of(
        P.all_of(P.compare("lang", ":", "d*"), P.compare("n_chars", ">=", 1000)),
        P.all_of(P.negate(P.compare("source", ":", "src?")), P.compare("n_chars", "<", 400)),
        P.compare("words", ":", "wh?", multi=True))
    return docs.filter(cond).select("doc_id", "lang", "n_chars")


def condition_exprs(spark, sf):
    e = events(spark, sf)
    c = P.condition
    return e.select(
        "event_id",
        c("equal", "event_type", "CLICK").alias("eq"),
        c("contains", "event_type", "Ur").alias("has"),
        c("starts_with", "event_type", "V").alias("starts"),
        c("ends_with", "event_type", "UP").alias("ends"),
        c("matches", "event_type", "^[ce]").alias("rx"),
        c("less", "value", 50.0, "number").alias("lt"),
        c("larger_equal", "value", 100.0, "number").alias("ge"),
        c("equal", "ts", "2024-01-05", "date").alias("on_day"),
        c("less_equal", "ts", "06:30:00", "time").alias("early"),
        c("larger", "ts", "2024-01-20", "date").alias("late"),
        c("empty", F.nullif("event_type", F.lit("view"))).alias("is_empty"),
        P.exclusive_or(c("equal", "event_type", "click"),
                       c("less", "value", 50.0, "number")).alias("either"))


def any_column_search(spark, sf):
    c = customer(spark, sf)
    return c.filter(P.any_column(c, "MACH|99", ignore_case=True)).select("c_custkey")


def any_column_fields(spark, sf):
    c = customer(spark, sf)
    per_field = P.all_of(F.col("c_name").rlike("[05]$"), F.col("c_mktsegment").rlike("(?i)^b"))
    return c.filter(per_field).select("c_custkey", "c_name")


def multi_key_sort(spark, sf):
    o = orders(spark, sf).withColumn(
        "price", F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_totalprice")))
    keys = [ops.sort_key("o_orderpriority", ranks=RANKS), ops.sort_key("price", descending=True),
            ops.sort_key("o_orderkey")]
    return row_numbers(o, keys, "pos").select("o_orderkey", "pos")


def page_with_total(spark, sf):
    o = ops.where(orders(spark, sf), {"o_orderstatus": "O"})
    keys = [ops.sort_key("o_totalprice", descending=True), ops.sort_key("o_orderkey")]
    return ops.page_with_total(o, keys, 20, 30).select("o_orderkey", "o_totalprice", "total")


def top_k(spark, sf):
    o = orders(spark, sf).filter("o_totalprice < 200000")
    keys = [ops.sort_key("o_totalprice", descending=True), ops.sort_key("o_orderkey")]
    return ops.top_k(o, keys, 10).select("o_orderkey", "o_totalprice")


def record_query(spark, sf):
    keys = [ops.sort_key("c_acctbal"), ops.sort_key("c_custkey")]
    return ops.record_query(customer(spark, sf), {"c_mktsegment": "BUILDING"}, keys, 5, 25).select(
        "c_custkey", "c_acctbal", "total")


def interval_overlap_join(spark, sf):
    e = events(spark, sf).select(
        "event_id", "user_id", "event_type", epoch_us("ts").alias("start"),
        (epoch_us("ts") + (F.round(F.col("value") * 100) * 600_000).cast("long")).alias("end"))
    side = lambda s: e.select("user_id", *[
        F.col(c).alias(f"{s}{name}") for c, name in (("event_id", "_id"), ("event_type", "_type"),
                                                     ("start", "0"), ("end", "1"))])
    met = overlap_join(side("a"), side("b"), ("a0", "a1"), ("b0", "b1"), on=["user_id"])
    return met.filter("a_type < b_type").select(
        "user_id", "a_id", "b_id", (F.least("a1", "b1") - F.greatest("a0", "b0")).alias("shared"))


def query_by_example_join(spark, sf):
    examples = supplier(spark, sf).select(
        F.col("s_suppkey").alias("example"),
        F.when(F.col("s_acctbal") > 1000, F.col("s_nationkey")).alias("c_nationkey"),
        F.when(F.col("s_acctbal") > 6000, F.lit("BUILDING"))
        .when(F.col("s_acctbal") < 3000, F.lit("MACHINERY")).alias("c_mktsegment"))
    rows = customer(spark, sf).select("c_custkey", "c_nationkey", "c_mktsegment")
    return example_join(rows, examples, ["c_nationkey", "c_mktsegment"], "example").select(
        "c_custkey", "example")


def tree_flatten(spark, sf):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")

    def key(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    edges = nation.select(key("r", "n_regionkey").alias("parent"), key("n", "n_nationkey").alias(
        "child")).unionByName(customer(spark, sf).select(
            key("n", "c_nationkey").alias("parent"), key("c", "c_custkey").alias("child")))
    return flatten(edges, region.select(key("r", "r_regionkey").alias("node")))


def _words():
    return F.regexp_extract_all("text", F.lit(WORD), F.lit(0))


def hof_map_filter_every_some(spark, sf):
    c = conversations(spark, sf).select("conv_id", "turn", _words().alias("w"))
    return c.select(
        "conv_id", "turn",
        F.array_join(F.transform(F.filter("w", lambda x: F.length(x) > 6), F.upper), " ").alias("long"),
        F.forall("w", lambda x: F.length(x) >= 2).alias("every"),
        F.exists("w", lambda x: x == "the").alias("some"))


def hof_fold(spark, sf):
    c = conversations(spark, sf).select("conv_id", "turn", _words().alias("w"))
    c = c.select("conv_id", "turn", F.transform("w", lambda x: F.length(x).cast("long")).alias("n"))
    return c.select(
        "conv_id", "turn",
        arrays.fold_left(F.col("n"), F.lit(0).cast("long"), lambda a, x: (a * 31 + x) % 1000003
                         ).alias("left_fold"),
        arrays.fold_right(F.col("n"), F.lit(0).cast("long"), lambda a, x: (a * 31 + x) % 1000003
                          ).alias("right_fold"),
        F.element_at(arrays.scan_left(F.col("n"), F.lit(0).cast("long"), lambda a, x: a + x), -1
                     ).alias("total"))


def zip_unzip(spark, sf):
    c = conversations(spark, sf).select("conv_id", "turn", _words().alias("w"))
    long = F.filter("w", lambda x: F.length(x) > 6)
    pairs = arrays.zip_shortest(F.col("w"), F.transform(long, F.length))
    c = c.select("conv_id", "turn", pairs.alias("p"))
    words, sizes = arrays.unzip(F.col("p"), ["a0", "a1"])
    return c.select("conv_id", "turn", F.size("p").cast("long").alias("n"),
                    F.array_join(words, " ").alias("words"),
                    F.array_join(F.transform(sizes, lambda x: x.cast("string")), " ").alias("sizes"))


def date_bucket(spark, sf):
    f = dates.floor_us
    return events(spark, sf).select(
        "event_id", f("ts", "day").alias("day"), f("ts", "week").alias("week"),
        f("ts", "week", first_day=1).alias("iso_week"), f("ts", "month").alias("month"),
        f("ts", "minute", 25).alias("m25"), f("ts", "hour", 7).alias("h7"))


def date_add(spark, sf):
    add = dates.date_add
    return orders(spark, sf).select(
        "o_orderkey", add("o_orderdate", "month", 13).alias("m"),
        add("o_orderdate", "quarter", -1).alias("q"), add("o_orderdate", "year", 1).alias("y"),
        add("o_orderdate", "week", 2).alias("w"), add("o_orderdate", "hour", 36).alias("h"),
        add("o_orderdate", "millisecond", 1500).alias("ms"),
        add("o_orderdate", "weekday", 7).alias("wd"), add("o_orderdate", "weekday", -3).alias("wdb"))


def date_diff(spark, sf):
    fixed = F.lit("1998-02-17 09:30:00").cast("timestamp_ntz")
    diff = dates.date_diff
    return orders(spark, sf).select("o_orderkey", *[
        diff("o_orderdate", fixed, unit).alias(f"{unit}s")
        for unit in ("year", "quarter", "month", "week", "day", "hour", "minute", "second",
                     "weekday")])


_WEEKDAYS = """
  (SELECT count(*) FROM generate_series(
     least(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(days AS INTEGER)),
     greatest(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(days AS INTEGER)),
     INTERVAL 1 DAY) g(d)
   WHERE isodow(d) < 6 AND d <> CAST(o_orderdate AS DATE)) * sign(days)"""

QUERIES = {
    "match_filter": Query(match_filter, """
        SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
          AND regexp_matches(o_orderpriority, '^[12]-') AND o_totalprice > 100000"""),
    "named_filter": Query(named_filter, """
        SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_totalprice > 250000 AND o_orderstatus <> 'P'"""),
    "wildcard_match": Query(wildcard_match, """
        SELECT c_custkey, c_name LIKE 'Customer#%7_' AS seven, c_mktsegment ILIKE '%u_n%' AS ci,
          c_mktsegment LIKE '%u_n%' AS cs, c_name LIKE 'Customer#00000000_' AS escaped
        FROM customer"""),
    "bool_filter": Query(bool_filter, """
        SELECT doc_id, lang, n_chars FROM documents
        WHERE (lang LIKE 'd%' AND n_chars >= 1000) OR (source NOT LIKE 'src_' AND n_chars < 400)
          OR len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x LIKE 'wh_')) > 0"""),
    "condition_exprs": Query(condition_exprs, """
        SELECT event_id, event_type = 'click' AS eq, contains(event_type, 'ur') AS has,
          event_type LIKE 'v%' AS starts, event_type LIKE '%up' AS ends,
          regexp_matches(event_type, '^[ce]') AS rx, value < 50 AS lt, value >= 100 AS ge,
          CAST(ts AS DATE) = DATE '2024-01-05' AS on_day,
          strftime(ts, '%H:%M:%S') <= '06:30:00' AS early,
          CAST(ts AS DATE) > DATE '2024-01-20' AS late, event_type = 'view' AS is_empty,
          (event_type = 'click') <> (value < 50) AS either FROM events"""),
    "any_column_search": Query(any_column_search, """
        SELECT c_custkey FROM customer WHERE regexp_matches(CAST(c_custkey AS VARCHAR), '(?i)MACH|99')
          OR regexp_matches(c_name, '(?i)MACH|99') OR regexp_matches(c_mktsegment, '(?i)MACH|99')
          OR regexp_matches(CAST(c_nationkey AS VARCHAR), '99')
          OR regexp_matches(CAST(c_acctbal AS VARCHAR), '99')"""),
    "any_column_fields": Query(any_column_fields, """
        SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '[05]$')
          AND regexp_matches(c_mktsegment, '(?i)^b')"""),
    "multi_key_sort": Query(multi_key_sort, """
        SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 1
            WHEN '1-URGENT' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END ASC,
          CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END DESC NULLS FIRST,
          o_orderkey) - 1 AS pos FROM orders"""),
    "page_with_total": Query(page_with_total, """
        SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')
          AS total FROM orders WHERE o_orderstatus = 'O'
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 30 OFFSET 20"""),
    "top_k": Query(top_k, """
        SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 200000
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"""),
    "record_query": Query(record_query, """
        SELECT c_custkey, c_acctbal, count(*) OVER () AS total FROM customer
        WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal, c_custkey LIMIT 25 OFFSET 5"""),
    "interval_overlap_join": Query(interval_overlap_join, """
        WITH e AS (SELECT event_id, user_id, event_type, epoch_us(ts) AS s,
          epoch_us(ts) + CAST(round(value * 100) * 600000 AS BIGINT) AS f FROM events)
        SELECT a.user_id, a.event_id AS a_id, b.event_id AS b_id,
          least(a.f, b.f) - greatest(a.s, b.s) AS shared
        FROM e a JOIN e b ON a.user_id = b.user_id AND a.s < b.f AND b.s < a.f
        WHERE a.event_type < b.event_type"""),
    "query_by_example_join": Query(query_by_example_join, """
        WITH ex AS (SELECT min(s_suppkey) AS example, n, m FROM (SELECT s_suppkey,
            CASE WHEN s_acctbal > 1000 THEN s_nationkey END AS n,
            CASE WHEN s_acctbal > 6000 THEN 'BUILDING' WHEN s_acctbal < 3000 THEN 'MACHINERY' END
              AS m FROM supplier) GROUP BY n, m)
        SELECT c_custkey, example FROM customer JOIN ex
          ON (n IS NULL OR n = c_nationkey) AND (m IS NULL OR m = c_mktsegment)"""),
    "tree_flatten": Query(tree_flatten, """
        WITH RECURSIVE edges AS (
          SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation
          UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
        tree(node, depth, path) AS (
          SELECT 'r' || r_regionkey, 0, 'r' || r_regionkey FROM region
          UNION ALL SELECT e.child, t.depth + 1, t.path || '/' || e.child
          FROM tree t JOIN edges e ON e.parent = t.node)
        SELECT node, depth, path FROM tree"""),
    "hof_map_filter_every_some": Query(hof_map_filter_every_some, """
        WITH c AS (SELECT conv_id, turn, regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+') AS w
                   FROM conversations)
        SELECT conv_id, turn, coalesce(array_to_string(list_transform(list_filter(w,
            lambda x: length(x) > 6), lambda x: replace(upper(x), 'ẞ', 'SS')), ' '), '') AS long,
          len(list_filter(w, lambda x: length(x) < 2)) = 0 AS every,
          list_contains(w, 'the') AS some FROM c"""),
    "hof_fold": Query(hof_fold, """
        WITH c AS (SELECT conv_id, turn, list_transform(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+'),
                     lambda x: CAST(length(x) AS BIGINT)) AS n FROM conversations)
        SELECT conv_id, turn,
          list_reduce(list_prepend(CAST(0 AS BIGINT), n), lambda a, x: (a * 31 + x) % 1000003) AS left_fold,
          list_reduce(list_prepend(CAST(0 AS BIGINT), list_reverse(n)),
                      lambda a, x: (a * 31 + x) % 1000003) AS right_fold,
          CAST(coalesce(list_sum(n), 0) AS BIGINT) AS total FROM c"""),
    "zip_unzip": Query(zip_unzip, """
        WITH c AS (SELECT conv_id, turn, regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+') AS w
                   FROM conversations),
        z AS (SELECT *, list_transform(list_filter(w, lambda x: length(x) > 6), lambda x: length(x)) AS s FROM c)
        SELECT conv_id, turn, least(len(w), len(s)) AS n,
          coalesce(array_to_string(w[1:least(len(w), len(s))], ' '), '') AS words,
          coalesce(array_to_string(s[1:least(len(w), len(s))], ' '), '') AS sizes FROM z"""),
    "date_bucket": Query(date_bucket, """
        SELECT event_id, epoch_us(date_trunc('day', ts)) AS day,
          epoch_us(date_trunc('day', ts)) - dayofweek(ts) * 86400000000 AS week,
          epoch_us(date_trunc('week', ts)) AS iso_week, epoch_us(date_trunc('month', ts)) AS month,
          epoch_us(date_trunc('hour', ts)) + (minute(ts) // 25) * 25 * 60000000 AS m25,
          epoch_us(date_trunc('day', ts)) + (hour(ts) // 7) * 7 * 3600000000 AS h7 FROM events"""),
    "date_add": Query(date_add, """
        SELECT o_orderkey, o_orderdate + INTERVAL 13 MONTH AS m, o_orderdate - INTERVAL 3 MONTH AS q,
          o_orderdate + INTERVAL 1 YEAR AS y, o_orderdate + INTERVAL 14 DAY AS w,
          o_orderdate + INTERVAL 36 HOUR AS h, o_orderdate + INTERVAL 1500 MILLISECOND AS ms,
          (SELECT d FROM (SELECT d, row_number() OVER (ORDER BY d) AS k
             FROM generate_series(o_orderdate + INTERVAL 1 DAY, o_orderdate + INTERVAL 20 DAY,
                                  INTERVAL 1 DAY) g(d) WHERE isodow(d) < 6) WHERE k = 7) AS wd,
          (SELECT d FROM (SELECT d, row_number() OVER (ORDER BY d DESC) AS k
             FROM generate_series(o_orderdate - INTERVAL 10 DAY, o_orderdate - INTERVAL 1 DAY,
                                  INTERVAL 1 DAY) g(d) WHERE isodow(d) < 6) WHERE k = 3) AS wdb
        FROM orders"""),
    "date_diff": Query(date_diff, f"""
        WITH o AS (SELECT o_orderkey, o_orderdate, TIMESTAMP '1998-02-17 09:30:00' AS t,
          CAST(floor((epoch_us(TIMESTAMP '1998-02-17 09:30:00') - epoch_us(o_orderdate))
            / 86400000000.0 + 0.5) AS BIGINT) AS days FROM orders)
        SELECT o_orderkey, date_diff('year', o_orderdate, t) AS years,
          date_diff('quarter', o_orderdate, t) AS quarters,
          date_diff('month', o_orderdate, t) AS months, CAST(trunc(days / 7.0) AS BIGINT) AS weeks,
          days,
          CAST(floor((epoch_us(t) - epoch_us(o_orderdate)) / 3600000000.0 + 0.5) AS BIGINT) AS hours,
          CAST(floor((epoch_us(t) - epoch_us(o_orderdate)) / 60000000.0 + 0.5) AS BIGINT) AS minutes,
          CAST(floor((epoch_us(t) - epoch_us(o_orderdate)) / 1000000.0 + 0.5) AS BIGINT) AS seconds,
          CAST({_WEEKDAYS} AS BIGINT) AS weekdays FROM o"""),
}
