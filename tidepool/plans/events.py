"""Time and stream queries over ``events``, ``pages`` and ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.config import IndexConfig
from tidepool.functions.dates import epoch_us, instant
from tidepool.functions.urls import acceptable_path
from tidepool.operators import index as index_ops
from tidepool.operators import timing as ops
from tidepool.operators.crawl import extract_links
from tidepool.operators.records import sort_key
from tidepool.plans import Query, changes, table
from tidepool.plans.crawl import LINKS_SQL, ROOTS, accept, scope
from tidepool.plans.index import CFG, POSTINGS_SQL, SHARDED_SQL
from tidepool.schemas import EVENTS, PAGES
from tidepool.storage import scratch_path
from tidepool.streaming import common
from tidepool.streaming import crawl as crawl_streams
from tidepool.streaming import events as streams

HOUR = 3_600_000_000
PAGE_PARTS = 10  # enough micro-batches for two levels of merged blocks


def _events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", epoch_us("ts").alias("us"))


def _event_stream(spark, sf, parts=4):
    """The events in ranges of their ids, each of which is a micro-batch."""
    return common.arriving(table(spark, sf, "events"), "event_id", parts, EVENTS)


def _page_stream(spark, sf, parts=4):
    return common.arriving(table(spark, sf, "pages"), "page_id", parts, PAGES)


def _arrival_sql(column: str, source: str, parts: int = 4) -> str:
    """The micro-batch of a row, as ``arriving`` deals them out."""
    low, high = (f"(SELECT {f}({column}) FROM {source})" for f in ("min", "max"))
    return f"coalesce((({column} - {low}) * {parts}) // ({high} - {low} + 1), 0)::INTEGER"


def flow_rate(spark, sf):
    rates = ops.flow_rate(table(spark, sf, "events"), "ts", 21_600,
                          F.round(F.col("value") * 100).cast("long"), ["event_type"])
    return rates.select("event_type", epoch_us("window.start").alias("start_us"),
                        F.round("rate", 9).alias("rate"))


def debounce(spark, sf):
    out = ops.debounce(_events(spark, sf), ["user_id"], "us", "event_id", HOUR)
    return out.select("event_id", "user_id", "fired_us")


def throttle(spark, sf):
    out = ops.throttle(_events(spark, sf), ["event_type"], "us", "event_id", HOUR)
    return out.select("event_id", "event_type", "us")


def idle_sessions(spark, sf):
    return ops.idle_sessions(_events(spark, sf), ["user_id"], "us", "event_id", 2 * HOUR)


def _body():
    return F.concat_ws(" ", "event_id", "user_id", "event_type", "props")


def event_batch_sink(spark, sf):
    out = ops.event_packets(table(spark, sf, "events"), "event_id", _body(), 2000)
    return out.groupBy("packet").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"),
                                     F.min("event_id").alias("first_id"))


def event_packet_stream(spark, sf):
    path = scratch_path(spark, "packets")
    streams.packet_sink(_event_stream(spark, sf), path, "event_id", _body(), 2000)
    return spark.read.parquet(path).groupBy("batch", "packet").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"),
        F.min("event_id").alias("first_id"))


def frontier_stream(spark, sf):
    path = scratch_path(spark, "frontier")
    links = extract_links(_page_stream(spark, sf), ROOTS).select(F.col("dst").alias("url"))
    crawl_streams.frontier_stream(links, path)
    return spark.read.schema(crawl_streams.FRONTIER).parquet(path).select("url")


def incremental_index(spark, sf):
    path = scratch_path(spark, "postings")
    query = crawl_streams.incremental_index(_page_stream(spark, sf, PAGE_PARTS), path, CFG)
    return crawl_streams.open_index(spark, path, common.batches(query))


def crawl_stream(spark, sf):
    frontier, index = scratch_path(spark, "frontier"), scratch_path(spark, "postings")
    pages = table(spark, sf, "pages")
    query = crawl_streams.crawl_stream(_page_stream(spark, sf), frontier, index, ROOTS, CFG,
                                       snapshot=pages, fanout=2)
    found = spark.read.schema(crawl_streams.FRONTIER).parquet(frontier).select(
        F.lit("frontier").alias("part"), F.col("url").alias("name"), F.lit(1).cast("long").alias("n"))
    postings = crawl_streams.open_index(spark, index, common.batches(query))
    terms = index_ops.term_stats(postings).select(
        F.lit("index").alias("part"), F.col("term").alias("name"), F.col("freq").alias("n"))
    dictionary = crawl_streams.complete_index(spark, index, scratch_path(spark, "done"),
                                              pages.count(), CFG)
    offsets = dictionary.select(F.lit("dictionary").alias("part"), F.col("term").alias("name"),
                                F.col("byte_offset").alias("n"))
    return found.unionByName(terms).unionByName(offsets)


def fan_out(spark, sf):
    outputs = {}

    def sink(name, make):
        def run(rows):
            path = scratch_path(spark, name)
            make(rows).write.parquet(path)
            outputs[name] = spark.read.parquet(path)
        return run

    pages = table(spark, sf, "pages")
    crawl_streams.fan_out(pages, [
        sink("links", lambda p: extract_links(p).groupBy(F.lit("links").alias("branch")).agg(
            F.count(F.lit(1)).alias("n"))),
        sink("accepted", lambda p: p.filter(acceptable_path("url")).groupBy(
            F.lit("accepted").alias("branch")).agg(F.count(F.lit(1)).alias("n"))),
        sink("postings", lambda p: index_ops.document_index(
            index_ops.page_text(p), IndexConfig()).groupBy(F.lit("postings").alias("branch")).agg(
                F.count(F.lit(1)).alias("n")))])
    return outputs["links"].unionByName(outputs["accepted"]).unionByName(outputs["postings"])


def flow_rate_stream(spark, sf):
    events = _event_stream(spark, sf).withColumn("ts", instant("ts"))
    rates = streams.flow_rate_stream(events, "ts", 21_600)
    path = scratch_path(spark, "rates")

    def keep(batch, batch_id):
        common.write_batch(batch, path, batch_id)

    # Update mode hands over every window that changed; the last version of each is the result.
    common.run_available(rates.writeStream.outputMode("update").foreachBatch(keep), spark=spark)
    done = spark.read.parquet(path)
    latest = done.groupBy("window").agg(F.max_by("rate", "batch").alias("rate"))
    return latest.select(F.unix_micros("window.start").alias("start_us"), F.round("rate", 9).alias("rate"))


def meter(spark, sf):
    path = scratch_path(spark, "meter")
    streams.meter_sink(_event_stream(spark, sf), path)
    return spark.read.schema("n BIGINT").parquet(path).agg(F.sum("n").alias("n"))


def late_rows(spark, sf):
    """Events that come in the order of a hash of their ids, so that many are late."""
    path = scratch_path(spark, "late")
    events = table(spark, sf, "events").withColumn("turn", F.conv(F.substring(
        F.md5(F.col("event_id").cast("string")), 1, 4), 16, 10).cast("int"))
    live = common.arriving(events, "turn", 6)
    streams.late_rows_sink(live.withColumn("ts", instant("ts")), "ts", path, "3 days")
    return spark.read.parquet(f"{path}/late").select("event_id", "batch")


def throttle_stream(spark, sf):
    path = scratch_path(spark, "throttle")
    events = _event_stream(spark, sf, 10).withColumn("us", epoch_us("ts"))
    streams.throttle_stream(events, path, "event_type", "us", "event_id", HOUR)
    return spark.read.parquet(f"{path}/passed").select("event_id", "event_type", "us")


def _sessions_done(spark, sf, gap):
    """A last file with one event of no user, days later, lets the watermark pass all sessions."""
    table_ = table(spark, sf, "events")
    folder, files = common.dealt(table_, "event_id")
    late = table_.agg((F.max("ts") + F.expr("INTERVAL 3 DAYS")).alias("ts"))
    late.select(*[(F.col("ts") if f.name == "ts" else F.lit(None)).cast(f.dataType).alias(f.name)
                  for f in EVENTS]).write.mode("append").parquet(folder)
    events = common.parquet_stream(spark, folder, EVENTS, files_per_trigger=files)
    sessions = streams.session_stream(events.withColumn("ts", instant("ts")), ["user_id"], "ts",
                                      "event_id", gap)
    path = scratch_path(spark, "sessions")

    def keep(batch, batch_id):
        common.write_batch(batch, path, batch_id)

    common.run_available(sessions.writeStream.outputMode("append").foreachBatch(keep), spark=spark)
    done = spark.read.parquet(path).filter("user_id IS NOT NULL")
    return done.select(
        "user_id", F.unix_micros("active_at").alias("active_us"),
        F.unix_micros("idle_at").alias("idle_us"),
        "event_id", "n")


def session_stream(spark, sf):
    return _sessions_done(spark, sf, "2 hours")


def debounce_stream(spark, sf):
    return _sessions_done(spark, sf, "1 hour").select("event_id", "user_id",
                                                      F.col("idle_us").alias("fired_us"))


def buffered_replay(spark, sf):
    path = scratch_path(spark, "replay")
    streams.buffered_replay(_event_stream(spark, sf), path, ["event_id"], minimum=50)
    return spark.read.parquet(f"{path}/sent").select("event_id", "event_type", "batch")


def live_query(spark, sf):
    path = scratch_path(spark, "live")
    lines = table(spark, sf, "lineitem")
    stream = changes.log_of(common.arriving(lines, "l_linenumber"))
    base = changes.base(spark, sf)
    keys = [sort_key("cents", descending=True), sort_key("key")]
    streams.live_query(base, stream, lambda df: df.filter("cents > 2500000"), ["cents"], keys,
                       path, order=changes.ORDER, rows_per_range=500)
    return spark.read.schema("key BIGINT, removed_from BIGINT, inserted_into BIGINT, batch INT").parquet(
        f"{path}/diff")


_USER = "PARTITION BY user_id ORDER BY ts, event_id"
def _packets(batch: str, columns: str) -> str:
    """Packets of at most 2000 bytes, filled anew in every batch."""
    return f"""
  WITH RECURSIVE e AS (SELECT event_id, {batch} AS batch,
                         strlen(concat_ws(' ', event_id, user_id, event_type, props)) AS bytes
                       FROM events),
  s AS (SELECT event_id, batch, bytes,
          sum(bytes) OVER (PARTITION BY batch ORDER BY event_id) AS hi,
          row_number() OVER (PARTITION BY batch ORDER BY event_id) AS nr FROM e),
  p(batch, nr, lo, packet) AS (
    SELECT DISTINCT batch, CAST(1 AS BIGINT), CAST(0 AS HUGEINT), CAST(1 AS BIGINT) FROM e
    UNION ALL
    SELECT n.batch, n.nr, n.hi - n.bytes, n.packet FROM (
      SELECT s.batch, s.nr, s.hi, s.bytes, p.packet + 1 AS packet,
        row_number() OVER (PARTITION BY s.batch ORDER BY s.nr) AS k
      FROM p JOIN s ON s.batch = p.batch AND s.nr > p.nr AND s.hi > p.lo + 2000) n WHERE n.k = 1),
  filled AS (SELECT s.*, (SELECT max(packet) FROM p WHERE p.batch = s.batch AND p.nr <= s.nr)
               AS packet FROM s)
  SELECT {columns} packet, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes,
    min(event_id) AS first_id
  FROM filled GROUP BY batch, packet"""


_THROTTLED = """
  WITH RECURSIVE e AS (SELECT event_id, event_type, epoch_us(ts) AS us,
      row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nr FROM events),
  t(event_id, event_type, us, nr) AS (
    SELECT event_id, event_type, us, nr FROM e WHERE nr = 1
    UNION ALL
    SELECT n.event_id, n.event_type, n.us, n.nr FROM (
      SELECT e.*, row_number() OVER (PARTITION BY e.event_type ORDER BY e.nr) AS k
      FROM t JOIN e ON e.event_type = t.event_type AND e.nr > t.nr AND e.us >= t.us + 3600000000
    ) n WHERE n.k = 1)
  SELECT event_id, event_type, us FROM t"""


_DEBOUNCED = f"""
  WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS us,
               lead(epoch_us(ts)) OVER ({_USER}) AS next FROM events)
  SELECT event_id, user_id, us + 3600000000 AS fired_us FROM e
  WHERE next IS NULL OR next - us > 3600000000"""


def _sessions(gap: str, cols: str) -> str:
    return f"""
        WITH e AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER ({_USER}) {gap} 7200000000
                     THEN 0 ELSE 1 END AS fresh FROM events),
        s AS (SELECT *, sum(fresh) OVER ({_USER} ROWS UNBOUNDED PRECEDING) AS session FROM e)
        SELECT user_id, {cols}, min(epoch_us(ts)) AS active_us,
          max(epoch_us(ts)) + 7200000000 AS idle_us, count(*) AS n FROM s GROUP BY user_id, session"""


QUERIES = {
    "flow_rate": Query(flow_rate, """
        SELECT event_type, CAST(epoch_us(ts) // 21600000000 * 21600000000 AS BIGINT) AS start_us,
          round(sum(CAST(round(value * 100) AS BIGINT)) / 21600.0, 9) AS rate
        FROM events GROUP BY 1, 2"""),
    "flow_rate_stream": Query(flow_rate_stream, """
        SELECT CAST(epoch_us(ts) // 21600000000 * 21600000000 AS BIGINT) AS start_us,
          round(count(*) / 21600.0, 9) AS rate FROM events GROUP BY 1"""),
    "meter": Query(meter, "SELECT count(*) AS n FROM events"),
    "late_rows": Query(late_rows, f"""
        WITH t AS (SELECT event_id, ts, ('0x' || substr(md5(event_id::VARCHAR), 1, 4))::INT AS turn
                   FROM events),
        e AS (SELECT event_id, ts, {_arrival_sql('turn', 't', 6)} AS batch FROM t),
        seen AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                   AND 1 PRECEDING) AS latest FROM e GROUP BY batch)
        SELECT event_id, batch FROM e JOIN seen USING (batch)
        WHERE ts <= date_trunc('millisecond', latest) - INTERVAL 3 DAYS"""),
    "debounce": Query(debounce, _DEBOUNCED),
    "debounce_stream": Query(debounce_stream, _DEBOUNCED),
    "throttle": Query(throttle, _THROTTLED),
    "throttle_stream": Query(throttle_stream, _THROTTLED),
    "idle_sessions": Query(idle_sessions, _sessions("<=", "CAST(session AS BIGINT) AS session")),
    "session_stream": Query(session_stream, _sessions(
        "<=", "max_by(event_id, (ts, event_id)) AS event_id")),
    "event_batch_sink": Query(event_batch_sink, _packets("0", "")),
    "event_packet_stream": Query(event_packet_stream, _packets(
        _arrival_sql("event_id", "events"), "batch,")),
    "frontier_stream": Query(frontier_stream, f"""
        WITH {LINKS_SQL} SELECT DISTINCT dst AS url FROM links
        WHERE {accept('dst')} AND {scope('dst')}"""),
    "incremental_index": Query(incremental_index,
                               f"WITH {POSTINGS_SQL} SELECT url, term, tf FROM postings"),
    "crawl_stream": Query(crawl_stream, f"""
        WITH {LINKS_SQL}, {SHARDED_SQL}
        SELECT DISTINCT 'frontier' AS part, dst AS name, CAST(1 AS BIGINT) AS n FROM links
        WHERE {accept('dst')} AND {scope('dst')}
        UNION ALL SELECT 'index', term, CAST(sum(tf) AS BIGINT) FROM postings GROUP BY term
        UNION ALL SELECT 'dictionary', term, CAST(min(before) AS BIGINT) FROM (
          SELECT term, sum(strlen(line) + 1) OVER (ORDER BY term, shard) - strlen(line) - 1 AS before
          FROM idx) GROUP BY term"""),
    "fan_out": Query(fan_out, f"""
        WITH {LINKS_SQL}, {POSTINGS_SQL}
        SELECT 'links' AS branch, count(*) AS n FROM links
        UNION ALL SELECT 'accepted', count(*) FROM pages WHERE {accept('url')}
        UNION ALL SELECT 'postings', count(*) FROM postings"""),
    "buffered_replay": Query(buffered_replay, f"""
        WITH e AS (SELECT event_type, event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos,
                     {_arrival_sql('event_id', 'events')} AS part FROM events),
        seen AS (SELECT part, sum(count(*)) OVER (ORDER BY part) AS n FROM e GROUP BY part)
        SELECT event_id, event_type,
          coalesce((SELECT min(part) FROM seen WHERE seen.n - 50 > e.pos), 4)::INTEGER AS batch
        FROM e"""),
    "live_query": Query(live_query, f"""
        WITH {changes.LOG_SQL},
        b AS (SELECT unnest(range(-1, 4))::INTEGER AS b),
        upto AS (SELECT b, key, op, cents FROM (
            SELECT b, c.*, row_number() OVER (PARTITION BY b, key ORDER BY nr DESC) AS k
            FROM (SELECT *, {_arrival_sql('seq', 'log')} AS part FROM checked) c
            JOIN b ON c.part <= b.b WHERE NOT error) WHERE k = 1),
        states AS (
          SELECT b, key, cents FROM base, b WHERE NOT EXISTS (
            SELECT 1 FROM upto u WHERE u.b = b.b AND u.key = base.key)
          UNION ALL SELECT b, key, cents FROM upto WHERE op <> 'remove'),
        placed AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY cents DESC, key) - 1 AS pos
          FROM states WHERE cents > 2500000),
        o AS (SELECT b + 1 AS b, key, cents, pos FROM placed WHERE b < 3),
        n AS (SELECT * FROM placed WHERE b >= 0)
        SELECT coalesce(o.b, n.b)::INTEGER AS batch, coalesce(o.key, n.key) AS key,
          coalesce(o.pos, -1) AS removed_from, coalesce(n.pos, -1) AS inserted_into
        FROM o FULL JOIN n ON o.b = n.b AND o.key = n.key
        WHERE o.cents IS DISTINCT FROM n.cents AND coalesce(o.pos, -1) <> coalesce(n.pos, -1)"""),
}
