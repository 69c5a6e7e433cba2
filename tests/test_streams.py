"""Streams in several micro-batches give what the batch operators give."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidepool.config import IndexConfig
from tidepool.functions.dates import epoch_us, instant
from tidepool.functions.urls import acceptable_path
from tidepool.operators import index as ix
from tidepool.operators import timing
from tidepool.operators.changes import apply_changes
from tidepool.operators.crawl import extract_links
from tidepool.operators.records import sort_key
from tidepool.schemas import EVENTS, PAGES
from tidepool.storage import scratch_path
from tidepool.streaming import common, crawl, events

WAIT = 3_600_000_000


def split(spark, df, order, parts):
    """Files in order of time, so that each becomes a micro-batch."""
    path = scratch_path(spark, "input")
    bounds = df.approxQuantile(order, [i / parts for i in range(1, parts)], 0.0)
    for i, (low, high) in enumerate(zip([None, *bounds], [*bounds, None])):
        part = df
        if low is not None:
            part = part.filter(F.col(order) >= low)
        if high is not None:
            part = part.filter(F.col(order) < high)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def event_files(spark, sf):
    return split(spark, spark.read.parquet(f"{sf}/events.parquet"), "event_id", 4)


@pytest.fixture(scope="module")
def page_files(spark, sf):
    return split(spark, spark.read.parquet(f"{sf}/pages.parquet"), "page_id", 3)


def stream(spark, folder, schema):
    return common.parquet_stream(spark, folder, schema, files_per_trigger=1)


def collected(spark, df):
    path = scratch_path(spark, "out")
    common.run_available(df.writeStream.format("parquet").option("path", path), spark=spark)
    return spark.read.schema(df.schema).parquet(path)


def test_throttle(spark, event_files):
    source = spark.read.parquet(event_files).withColumn("us", epoch_us("ts"))
    want = timing.throttle(source, ["event_type"], "us", "event_id", WAIT)
    live = stream(spark, event_files, EVENTS).withColumn("us", epoch_us("ts"))
    path = scratch_path(spark, "throttle")
    events.throttle_stream(live, path, "event_type", "us", "event_id", WAIT)
    got = spark.read.parquet(f"{path}/passed")
    assert got.select("batch").distinct().count() == 4
    assert rows(got, "event_id") == rows(want, "event_id")


def test_throttle_drops_late_events(spark, tmp_path):
    schema = "k STRING, us LONG, id LONG"
    for i, batch in enumerate([[("a", 100, 1), ("b", 5, 2)], [("a", 90, 3), ("a", 105, 4), ("a", 100, 0),
                                                              ("b", 15, 5), ("a", 111, 6)]]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = common.parquet_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema,
                                 files_per_trigger=1)
    events.throttle_stream(live, str(tmp_path / "out"), "k", "us", "id", 10)
    assert rows(spark.read.parquet(str(tmp_path / "out/passed")), "id") == [(1,), (2,), (5,), (6,)]


def test_flow_rate_closes_windows(spark, event_files):
    live = stream(spark, event_files, EVENTS).withColumn("ts", instant("ts"))
    got = collected(spark, events.flow_rate_stream(live, "ts", 21_600))
    source = spark.read.parquet(event_files).withColumn("ts", instant("ts"))
    want = timing.flow_rate(source, "ts", 21_600)
    closed, everything = rows(got), rows(want)
    assert closed and set(closed) <= set(everything)
    # Only windows the watermark has not passed yet stay open at the end.
    assert len(everything) - len(closed) <= 2


def test_sessions(spark, event_files):
    source = spark.read.parquet(event_files).withColumn("us", epoch_us("ts"))
    want = timing.idle_sessions(source, ["user_id"], "us", "event_id", 2 * WAIT)
    live = stream(spark, event_files, EVENTS).withColumn("ts", instant("ts"))
    sessions = events.session_stream(live, ["user_id"], "ts", "event_id", "2 hours")
    got = collected(spark, sessions).select("user_id", F.unix_micros("active_at").alias("a"),
                                            F.unix_micros("idle_at").alias("i"), "n", "event_id")
    closed = rows(got, "user_id", "a", "i", "n")
    assert closed and set(closed) <= set(rows(want, "user_id", "active_us", "idle_us", "n"))
    last = timing.debounce(source, ["user_id"], "us", "event_id", 2 * WAIT)
    assert set(rows(got, "event_id")) <= set(rows(last, "event_id"))


def test_meter(spark, event_files):
    df, seen = events.meter(spark.read.parquet(event_files), "passed")
    assert df.count() == seen.get["n"] == 1000
    live = events.meter_stream(stream(spark, event_files, EVENTS), "elements")
    query = common.run_available(live.writeStream.format("noop"), spark=spark)
    counts = [p.observedMetrics["elements"].n for p in query.recentProgress
              if "elements" in p.observedMetrics and p.numInputRows]
    assert len(counts) == 4 and sum(counts) == 1000


def test_packets_per_interval(spark, event_files):
    path = scratch_path(spark, "packets")
    body = F.concat_ws(" ", "event_id", "props")
    events.packet_sink(stream(spark, event_files, EVENTS), path, "event_id", body, 300)
    sent = spark.read.parquet(path)
    assert sent.count() == 1000 and sent.select("batch").distinct().count() == 4
    sizes = sent.groupBy("batch", "packet").agg(F.sum("bytes").alias("b"))
    assert sizes.agg(F.max("b")).first()[0] <= 300


def test_replay_ticks(spark, event_files):
    path = scratch_path(spark, "replay")
    events.buffered_replay(stream(spark, event_files, EVENTS), path)
    ticks = rows(spark.read.parquet(f"{path}/sent").groupBy("batch").agg(
        F.min("event_id").alias("first"), F.max("event_id").alias("last")))
    assert len(ticks) == 4 and ticks[0][1] == 0 and ticks[-1][2] == 999
    assert all(after[1] == before[2] + 1 for before, after in zip(ticks, ticks[1:]))


def test_replay_keeps_a_buffer(spark, event_files):
    path = scratch_path(spark, "replay")
    events.buffered_replay(stream(spark, event_files, EVENTS), path, ["event_id"], minimum=100)
    sizes = [r[1] for r in rows(spark.read.parquet(f"{path}/sent").groupBy("batch").count())]
    assert len(sizes) == 5 and sum(sizes) == 1000 and sizes[-1] == 100 and sizes[0] < 160


def test_meter_sink_counts_every_batch(spark, event_files):
    path = scratch_path(spark, "meter")
    events.meter_sink(stream(spark, event_files, EVENTS), path)
    sizes = [r[0] for r in rows(spark.read.parquet(path), "n")]
    assert len(sizes) == 4 and sum(sizes) == 1000


def test_a_page_that_comes_twice_counts_once(spark):
    path = scratch_path(spark, "postings")
    schema = "url STRING, term STRING, tf BIGINT"
    common.write_batch(spark.createDataFrame([("u", "a", 2), ("u", "b", 1), ("v", "a", 1)], schema), path, 0)
    common.write_batch(spark.createDataFrame([("u", "a", 3)], schema), path, 1)
    assert rows(crawl.read_postings(spark, path)) == [("u", "a", 3), ("v", "a", 1)]


def test_crawl_stream_fetches_what_it_finds(spark, tmp_path):
    snapshot = spark.createDataFrame(
        [(1, "http://h/a.html", '<a href="b.html">x</a> one'), (2, "http://h/b.html", '<a href="c.html">y</a> two'),
         (3, "http://h/c.html", "three"), (4, "http://h/lost.html", "four")], PAGES)
    snapshot.filter("page_id = 1").coalesce(1).write.parquet(str(tmp_path / "in"))
    frontier, index = scratch_path(spark, "frontier"), scratch_path(spark, "index")
    live = common.parquet_stream(spark, str(tmp_path / "in"), PAGES, files_per_trigger=1)
    crawl.crawl_stream(live, frontier, index, snapshot=snapshot)
    assert rows(crawl.read_postings(spark, index), "term") == [("one",), ("three",), ("two",), ("x",), ("y",)]
    done = crawl.complete_index(spark, index, str(tmp_path / "done"), 3)
    whole = ix.document_index(ix.page_text(snapshot.filter("page_id < 4")))
    assert rows(done) == rows(ix.build_dictionary(ix.inverted_index(whole, 1)))


def test_incremental_index(spark, page_files):
    path, cfg = scratch_path(spark, "postings"), IndexConfig()
    crawl.incremental_index(stream(spark, page_files, PAGES), path, cfg)
    assert spark.read.parquet(path).select("batch").distinct().count() == 3
    want = ix.document_index(ix.page_text(spark.read.parquet(page_files)), cfg)
    assert rows(crawl.read_postings(spark, path), "url", "term", "tf") == rows(
        want, "url", "term", "tf")


def test_rerun_of_a_batch_changes_nothing(spark, page_files):
    pages = spark.read.parquet(page_files)
    path = scratch_path(spark, "rerun")
    block = ix.document_index(ix.page_text(pages))
    common.write_batch(block, path, 0)
    common.write_batch(block, path, 0)
    assert crawl.read_postings(spark, path).agg(F.sum("tf")).first() == block.agg(F.sum("tf")).first()


def test_crawl_stream(spark, page_files):
    frontier, index = scratch_path(spark, "frontier"), scratch_path(spark, "index")
    crawl.crawl_stream(stream(spark, page_files, PAGES), frontier, index)
    pages = spark.read.parquet(page_files)
    links = extract_links(pages).select(F.col("dst").alias("url")).filter(acceptable_path("url"))
    found = spark.read.schema(crawl.FRONTIER).parquet(frontier)
    assert rows(found, "url") == rows(links.distinct(), "url")
    merged = ix.inverted_index(crawl.read_postings(spark, index), 2)
    whole = ix.inverted_index(ix.document_index(ix.page_text(pages)), 2)
    assert rows(merged) == rows(whole)


def test_dedupe_stream(spark, tmp_path):
    schema = "url STRING, seen TIMESTAMP"
    data = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "url STRING, s INT").select(
        "url", F.timestamp_seconds("s").alias("seen"))
    data.write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    assert rows(collected(spark, crawl.dedupe_stream(live, "seen")), "url") == [("a",), ("b",)]


def test_live_query(spark):
    base = spark.createDataFrame([(k, k * 10) for k in range(20)], "key LONG, v LONG")
    log = spark.createDataFrame(
        [(i % 23, i, ["put", "add", "remove"][i % 3], i * 3) for i in range(60)],
        "key LONG, seq LONG, op STRING, v LONG")
    folder, path = split(spark, log, "seq", 3), scratch_path(spark, "live")
    live = common.parquet_stream(spark, folder, log.schema, files_per_trigger=1)
    events.live_query(base, live, lambda df: df.filter("v > 50"), ["v"],
                      [sort_key("v"), sort_key("key")], path)
    want, _ = apply_changes(base, log, ["v"])
    assert rows(events.live_state(base, path, ["v"]), "key", "v") == rows(want, "key", "v")
    diffs = spark.read.parquet(f"{path}/diff")
    entered = diffs.filter("removed_from = -1").count() - diffs.filter("inserted_into = -1").count()
    assert entered == want.filter("v > 50").count() - base.filter("v > 50").count()


def test_fan_out_reads_once(spark, page_files):
    seen = []
    crawl.fan_out(spark.read.parquet(page_files), [lambda d: seen.append(d.count()),
                                                   lambda d: seen.append(d.is_cached)])
    assert seen == [50, True]
