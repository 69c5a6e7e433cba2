"""State that streams keep: merged blocks, the visited set, the index under re-delivery, throttles that
forget, live results by ranges."""

import os

from conftest import rows
from pyspark.sql import functions as F

from tidepool.config import IndexConfig
from tidepool.operators import index as ix
from tidepool.operators.changes import apply_changes, snapshot_diff
from tidepool.operators.records import sort_key
from tidepool.schemas import PAGES
from tidepool.storage import scratch_path
from tidepool.streaming import common, crawl, events
from tidepool.streaming.tiers import Parts, VisitedSet


def urls(spark, names):
    return spark.createDataFrame([(f"http://h/{n}",) for n in names], "url STRING")


def test_visited_set_against_a_set(spark, tmp_path):
    visited, known = VisitedSet(spark, str(tmp_path / "v"), buckets=8, fanout=3), set()
    for batch in range(10):
        some = [(batch * 37 + i * i) % 211 for i in range(30)] * 2
        got = {r["url"] for r in visited.unseen(urls(spark, some), batch).collect()}
        want = {f"http://h/{n}" for n in some} - known
        assert got == want
        visited.add(spark.createDataFrame([(u,) for u in got], "url STRING"), batch)
        if batch == 6:  # the batch runs again, from what was there before it
            again = visited.unseen(urls(spark, some), batch)
            assert {r["url"] for r in again.collect()} == want
            visited.add(again, batch)
        known |= want
        blocks = visited.tiers.blocks(batch + 1)
        assert all(sum(b.level == level for b in blocks) < 3 for level in range(4))
    assert len(visited.tiers.blocks(10)) <= 4 and max(b.level for b in blocks) == 2
    assert visited.unseen(urls(spark, []), 10).count() == 0
    assert visited.unseen(spark.createDataFrame([(None,)], "url STRING"), 10).count() == 0


def scanned(df):
    """Rows that the scans of a plan gave."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_batch_opens_only_what_it_can_hit(spark, tmp_path):
    visited = VisitedSet(spark, str(tmp_path / "v"), buckets=16)
    many = spark.range(40_000).select(F.concat(F.lit("http://h/"), F.col("id")).alias("url"))
    visited.add(many, 0)
    few = visited.candidates(urls(spark, [5, 777_777]))
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "1000")
    try:
        seen = visited.opened(few, 1)
        plan = seen._jdf.queryExecution().toString()
        assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters:")[1][:200]
        assert "In(url" in plan
        assert scanned(seen) <= 2 * 40_000 / 16 * 1.3  # two of sixteen buckets
        # none of the URLs was seen: the Bloom filters spare the row groups as well
        assert scanned(visited.opened(visited.candidates(urls(spark, [900_001])), 1)) == 0
        assert rows(seen, "url") == [("http://h/5",)]
    finally:
        spark.conf.unset("spark.sql.parquet.pushdown.inFilterThreshold")


def page_stream(spark, tmp_path, batches):
    for batch in batches:
        spark.createDataFrame(batch, PAGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return common.parquet_stream(spark, str(tmp_path / "in"), PAGES, files_per_trigger=1)


def test_pages_that_come_again(spark, tmp_path):
    batches = [[(1, "u", "old words here"), (2, "v", "stays")], [(3, "w", "more")], [(1, "u", "new")],
               [(1, "u", "")], [(2, "v", None)], [(4, "x", "late old")], [(1, "u", "back again")]]
    path = scratch_path(spark, "postings")
    query = crawl.incremental_index(page_stream(spark, tmp_path, batches), path, fanout=2)
    n = common.batches(query)
    assert n == len(batches)
    latest = {page[1]: page for batch in batches for page in batch}
    whole = ix.document_index(ix.page_text(spark.createDataFrame(list(latest.values()), PAGES)))
    want = rows(whole, "url", "term", "tf")
    assert rows(crawl.open_index(spark, path, n), "url", "term", "tf") == want
    assert rows(crawl.read_postings(spark, path), "url", "term", "tf") == want
    after_four = crawl.open_index(spark, path, 4)  # the page came empty: it has no postings
    assert after_four.filter("url = 'u'").count() == 0
    blocks = crawl.index_tiers(spark, path, 2).blocks(n)
    assert len(blocks) <= 3 and max(b.level for b in blocks) == 2
    assert crawl.open_index(spark, path, 0).count() == 0


def test_merged_blocks_of_everything_hold_no_marks(spark, tmp_path):
    batches = [[(i, f"u{i % 3}", f"w{i}" if i % 2 else "")] for i in range(4)]
    path = scratch_path(spark, "postings")
    crawl.incremental_index(page_stream(spark, tmp_path, batches), path, IndexConfig(), fanout=2)
    block = crawl.index_tiers(spark, path, 2).blocks(4)
    assert len(block) == 1 and block[0].level == 2
    merged = spark.read.parquet(block[0].folder)
    assert merged.filter("term IS NULL").count() == 0
    assert rows(merged, "url", "term") == [("u0", "w3"), ("u1", "w1")]


def test_throttle_forgets_silent_keys(spark, tmp_path):
    schema = "k LONG, us LONG, id LONG"
    second = 1_000_000
    for batch in range(10):
        start = (1_700_000_000 + 3600 * batch) * second
        rows_ = [(batch * 20 + i, start + i * second, batch * 20 + i) for i in range(20)]
        rows_ += [(-1, start + i * second, 10_000 + batch * 20 + i) for i in range(20)]
        rows_ += [(-2, None, 20_000 + batch)]
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = common.parquet_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema,
                                 files_per_trigger=1)
    query = events.throttle_stream(live, str(tmp_path / "out"), "k", "us", "id", 5 * second)
    passed = spark.read.parquet(str(tmp_path / "out/passed"))
    assert passed.filter("k >= 0").count() == 200
    assert rows(passed.filter("k = -1 AND batch = 3"), "id") == [(10_060,), (10_065,), (10_070,), (10_075,)]
    kept = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    # values and timers of one or two batches, however many have gone by
    assert kept[-1] < max(kept) <= 4 * (2 * 21)


def test_rows_without_an_order_arrive_first(spark):
    df = spark.createDataFrame([(None if i % 2 else i, i) for i in range(40)], "k LONG, v LONG")
    folder = common.in_files(df, "k", 4, files=2)
    live = common.parquet_stream(spark, folder, df.schema, files_per_trigger=2)
    path = scratch_path(spark, "seen")
    common.run_available(live.writeStream.foreachBatch(
        lambda batch, n: common.write_batch(batch, path, n)), spark=spark)
    seen = spark.read.parquet(path)
    assert seen.count() == 40 and seen.select("batch").distinct().count() == 4
    assert seen.filter("k IS NULL").select("batch").distinct().first()[0] == 0
    spans = seen.groupBy("batch").agg(F.min("k").alias("a"), F.max("k").alias("b")).orderBy("batch").collect()
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))
    empty = spark.createDataFrame([], df.schema)
    assert os.path.basename(common.in_files(empty, "k")).startswith("arriving")


def test_a_large_range_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(common, "FILE_ROWS", 100)
    df = spark.createDataFrame([(i if i < 450 else 997 + i % 3, i) for i in range(500)], "k LONG, v LONG")
    df = df.filter("k < 997 OR v < 452")  # two rows in the last range, none in the one before
    folder, files = common.dealt(df, "k")
    stored = spark.read.parquet(folder).groupBy(F.input_file_name()).count()
    assert files == 3 and max(r["count"] for r in stored.collect()) <= 100
    path = scratch_path(spark, "seen")
    common.run_available(common.arriving(df, "k").writeStream.foreachBatch(
        lambda batch, n: common.write_batch(batch, path, n)), spark=spark)
    seen = spark.read.parquet(path).groupBy("batch").agg(F.count("k"), F.min("k"), F.max("k"))
    assert sorted(map(tuple, seen.collect())) == [(0, 250, 0, 249), (1, 200, 250, 449), (2, 2, 997, 998)]


def test_parts_replace_only_what_changes(spark, tmp_path):
    parts = Parts(spark, str(tmp_path / "p"), "k BIGINT", 4)
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 4).cast("int").alias("part"))
    parts.replace(table, -1, None)
    parts.replace(parts.read(0, [1]).filter("k > 20"), 0, [1])
    assert parts.read(0).count() == 40 and parts.read(1).count() == 35
    assert rows(parts.manifest(1), "part", "version", "n") == [(0, -1, 10), (1, 0, 5), (2, -1, 10), (3, -1, 10)]
    parts.replace(parts.read(1, [2]).filter("false"), 1, [2])
    assert parts.read(2).count() == 25 and parts.read(2, [2]).count() == 0


def test_live_positions_of_every_batch(spark, tmp_path):
    base = spark.createDataFrame([(k, (k * 37) % 101) for k in range(120)], "key LONG, v LONG")
    log = [(i * 7 % 150, i, ["put", "add", "remove", "put"][i % 4], (i * 53) % 131) for i in range(90)]
    schema = "key LONG, seq LONG, op STRING, v LONG"
    for i in range(3):
        spark.createDataFrame(log[30 * i:30 * i + 30], schema).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
    live = common.parquet_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema,
                                 files_per_trigger=1)
    path, sort = scratch_path(spark, "live"), [sort_key("v", descending=True), sort_key("key")]
    result = lambda df: df.filter("v > 30")
    events.live_query(base, live, result, ["v"], sort, path, buckets=8, ranges=16, rows_per_range=5)
    diffs = spark.read.schema("key LONG, removed_from LONG, inserted_into LONG, batch INT").parquet(
        f"{path}/diff")
    before = base
    for i in range(3):
        part = spark.createDataFrame(log[30 * i:30 * i + 30], schema)
        after, _ = apply_changes(before, part, ["v"])
        want = snapshot_diff(result(before), result(after), "key", sort, ["v"])
        got = diffs.filter(F.col("batch") == i)
        assert rows(got, "key", "removed_from", "inserted_into") == rows(want)
        before = spark.createDataFrame(after.collect(), after.schema)
    ranges = Parts(spark, f"{path}/ranges", "key BIGINT, v BIGINT", 16)
    versions = [r["version"] for r in ranges.manifest(1).collect()]
    assert -1 in versions and 0 in versions  # a batch leaves ranges that it does not touch alone


def test_late_rows_are_those_behind_the_watermark(spark, tmp_path):
    schema = "id LONG, at LONG"
    for batch in [[(1, 1000), (2, 1600)], [(3, 990), (4, 1000), (5, 1001), (6, None)], [(7, 5000)],
                  [(8, 4399), (9, 4400), (10, 4401), (11, 900)]]:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = common.parquet_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema,
                                 files_per_trigger=1).withColumn("ts", F.timestamp_seconds("at"))
    path = str(tmp_path / "out")
    events.late_rows_sink(live, "ts", path, "10 minutes")
    late = spark.read.parquet(f"{path}/late")
    assert {r["id"] for r in late.collect()} == {3, 4, 8, 9, 11}
    # Spark drops none but those, and lets some of them through for another batch
    counted = live.withWatermark("ts", "10 minutes").dropDuplicates(["id", "ts"])
    query = common.run_available(counted.writeStream.format("noop"), spark=spark)
    dropped = sum(p.stateOperators[0].numRowsDroppedByWatermark for p in query.recentProgress)
    assert 0 < dropped <= late.count()
