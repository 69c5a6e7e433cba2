"""Rates, counters, bursts, sessions, packets and live results of event streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tidepool.operators.changes import net_changes, overlay, settled
from tidepool.operators.ordered import order_chunks, row_numbers, running
from tidepool.operators.timing import event_packets, flow_rate
from tidepool.storage import materialize, ship_package
from tidepool.streaming.common import run_available, state_store, write_batch
from tidepool.streaming.tiers import Parts

WATERMARK = "10 minutes"


def flow_rate_stream(events: DataFrame, ts: str, seconds: int, metric: Column | None = None,
                     delay: str = WATERMARK) -> DataFrame:
    """Event-time rate; rows later than the watermark are dropped and counted by Spark."""
    return flow_rate(events.withWatermark(ts, delay), ts, seconds, metric)


def late_rows_sink(events: DataFrame, ts: str, path: str, delay: str = WATERMARK,
                   checkpoint: str | None = None):
    """Keep the rows that come behind a watermark of this delay on ``ts``, below ``path/late``.

    The watermark of a micro-batch is the latest time of all batches before it, less the delay; rows
    that are not after it come late.  Operators with that watermark drop no other rows; they may take
    some of these for a batch longer.  Each batch notes its own latest time below ``path/latest``, so
    a batch that runs again, or a query that starts anew from its checkpoint, finds the same rows.  A
    row without a time is never late.  Nothing but one row a batch is kept besides.
    """
    spark = events.sparkSession

    def keep(batch: DataFrame, batch_id: int) -> None:
        before = None if batch_id == 0 else spark.read.schema("latest TIMESTAMP, batch BIGINT").parquet(
            f"{path}/latest").filter(F.col("batch") < batch_id).agg(F.max("latest")).first()[0]
        # milliseconds, as watermarks count
        mark = F.date_trunc("millisecond", F.lit(before)) - F.expr(f"INTERVAL {delay}")
        late = batch.filter(F.lit(False) if before is None else F.col(ts) <= mark)
        write_batch(late, f"{path}/late", batch_id)
        write_batch(batch.agg(F.max(ts).alias("latest")), f"{path}/latest", batch_id)

    return run_available(events.writeStream.foreachBatch(keep), checkpoint, spark)


def meter(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Pass rows through and count them; read ``observation.get["n"]`` after an action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def meter_stream(df: DataFrame, name: str) -> DataFrame:
    """The same for a stream; the count appears in each progress under ``observedMetrics``, of which
    Spark remembers only the latest.  :func:`meter_sink` keeps all of them."""
    return df.observe(name, F.count(F.lit(1)).alias("n"))


def meter_sink(df: DataFrame, path: str, checkpoint: str | None = None):
    """The number of rows of every micro-batch, one row ``n`` in a folder of its own."""
    def count(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.agg(F.count(F.lit(1)).alias("n")), path, batch_id)

    return run_available(df.writeStream.foreachBatch(count), checkpoint)


def session_stream(events: DataFrame, keys: list[str], ts: str, tie: str, gap: str,
                   delay: str = WATERMARK) -> DataFrame:
    """Sessions of a key with a gap, and the event that closed each: idleness and debouncing.

    In append mode a session comes out, and leaves the state, when the watermark has passed its end.
    Sessions merge in the state store as partial aggregates; set
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` so that those of a batch
    are merged before the shuffle, too, and a key's events are never gathered.
    """
    window = F.session_window(ts, gap)
    return events.withWatermark(ts, delay).groupBy(*keys, window).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct(ts, tie)).alias("last")).select(
            *keys, F.col("session_window.start").alias("active_at"),
            F.col("session_window.end").alias("idle_at"), F.col(f"last.{tie}").alias(tie), "n")


class _Throttle(StatefulProcessor):
    """The time of the last event passed on, per key; it leaves the state when its wait is over."""

    def __init__(self, us: str, tie: str, wait_us: int):
        self.us, self.tie, self.wait = us, tie, wait_us

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows), ignore_index=True)
        us, tie = frame[self.us].to_numpy(), frame[self.tie]
        order = np.lexsort((tie.rank(method="first").to_numpy(), us))
        times = us[order]
        before = self.last.get() if self.last.exists() else None
        place = 0 if before is None else int(np.searchsorted(times, before[0] + self.wait))
        passed = []
        while place < len(times):
            passed.append(order[place])
            place = int(np.searchsorted(times, times[place] + self.wait))
        if passed:
            last = int(us[passed[-1]])
            self.last.update((last,))
            for due in list(self.handle.listTimers()):
                self.handle.deleteTimer(due[0] if isinstance(due, tuple) else due)
            self.handle.registerTimer(-(-(last + self.wait) // 1000))
        yield frame.iloc[passed]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        pass


def throttled(events: DataFrame, key: str, us: str, tie: str, wait_us: int, delay: str = WATERMARK
              ) -> DataFrame:
    """A stream (key, us, tie) of the first event per key, then the next at least ``wait_us`` later.

    The time of a key's last event is held in the state store until the watermark has passed the end
    of its wait: whatever comes then passes anyway.  So a micro-batch works on its own rows and on the
    keys whose wait ends, and keys that fall silent take no room.  Of a key's rows in a micro-batch
    only times and ties are gathered.  An event that is older than its key's last one, or later than
    the watermark allows, is dropped, and so is one without a time.  Start it within
    :func:`tidepool.streaming.common.state_store`.
    """
    rows = events.select(key, us, tie).filter(F.col(us).isNotNull())
    timed = rows.withColumn("_at", F.timestamp_micros(us)).withWatermark("_at", delay)
    ship_package(events.sparkSession)
    return timed.groupBy(key).transformWithStateInPandas(
        _Throttle(us, tie, wait_us), rows.schema, "append", "eventTime")


def throttle_stream(events: DataFrame, path: str, key: str, us: str, tie: str, wait_us: int,
                    checkpoint: str | None = None, delay: str = WATERMARK):
    """:func:`throttled`, with what passes in each micro-batch below ``path/passed``."""
    spark = events.sparkSession

    def keep(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_batch(batch, f"{path}/passed", batch_id)

    with state_store(spark):
        passed = throttled(events, key, us, tie, wait_us, delay)
        return run_available(passed.writeStream.outputMode("append").foreachBatch(keep), checkpoint,
                             spark)


def packet_sink(events: DataFrame, path: str, order: str, body: Column, max_bytes: int = 4000,
                checkpoint: str | None = None):
    """Push what each interval collected as packets of at most ``max_bytes``.

    ``packet`` is counted within the micro-batch; (batch, packet) names a packet.
    """
    def push(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            write_batch(event_packets(batch, order, body, max_bytes), path, batch_id)

    return run_available(events.writeStream.foreachBatch(push), checkpoint)


def buffered_replay(points: DataFrame, path: str, order: Sequence[str] = (), minimum: int = 0,
                    checkpoint: str | None = None):
    """Write each tick's share of a stream below ``path/sent``; limit ticks with
    ``files_per_trigger`` on reading.

    The last ``minimum`` rows in ``order`` stay in a buffer below ``path/kept`` until later ones
    come; when the stream ends the buffer is sent as well.
    """
    spark, schema = points.sparkSession, points.schema
    ticks: list[int] = []

    def tick(batch: DataFrame, batch_id: int) -> None:
        if not minimum:
            write_batch(batch, f"{path}/sent", batch_id)
            return
        held = spark.createDataFrame([], schema) if batch_id == 0 else spark.read.schema(
            schema).parquet(f"{path}/kept/batch={batch_id - 1}")
        rows = materialize(row_numbers(held.unionByName(batch), list(order), "_pos"), "buffer")
        last = rows.count() - minimum
        write_batch(rows.filter(F.col("_pos") < last).drop("_pos"), f"{path}/sent", batch_id)
        write_batch(rows.filter(F.col("_pos") >= last).drop("_pos"), f"{path}/kept", batch_id)
        ticks.append(batch_id)

    query = run_available(points.writeStream.foreachBatch(tick), checkpoint)
    if ticks:
        rest = spark.read.schema(schema).parquet(f"{path}/kept/batch={ticks[-1]}")
        write_batch(rest, f"{path}/sent", ticks[-1] + 1)
    return query


def live_query(base: DataFrame, changes: DataFrame, result: Callable[[DataFrame], DataFrame],
               payload: list[str], sort: list[Column], path: str, key: str = "key",
               order: Sequence[str] = ("seq",), checkpoint: str | None = None,
               buckets: int = 64, ranges: int = 64, rows_per_range: int = 100_000):
    """Keep a query result current while changes (key, order, op, payload) stream in.

    ``result`` works row by row: it filters rows or changes their payload.  ``sort`` ends in a unique
    column.  Every micro-batch writes its net changes below ``path/delta`` and below ``path/diff`` the
    rows that entered, left or changed in the result: (key, removed_from, inserted_into), positions
    from 0 in the order of ``sort`` before and after the batch, -1 for "not there".

    The state is kept in hash buckets of keys and the result in ranges of the sort order, with the
    rows of each counted.  A batch opens the buckets of its own keys and the ranges that these rows
    leave or enter; positions are the counts of the ranges before plus the place in the range.  When a
    range has grown to four times its share the ranges are drawn anew.
    """
    spark = base.sparkSession
    kept = base.select(key, *payload)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    state = Parts(spark, f"{path}/state", columns, buckets)
    placed = Parts(spark, f"{path}/ranges", columns, ranges)
    in_bucket = lambda df: df.withColumn("part", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))

    def draw_ranges(rows: DataFrame, batch_id: int) -> None:
        n = max(1, min(ranges, -(-rows.count() // rows_per_range)))
        cut = rows.select(key, *payload).repartitionByRange(n, *sort)
        placed.replace(cut.withColumn("part", F.spark_partition_id()), batch_id, None)
        own = Window.partitionBy("part").orderBy(*sort)
        borders = placed.read(batch_id + 1).withColumn("_first", F.row_number().over(own)).filter(
            "_first = 1 AND part > 0").drop("_first")  # a row for each range
        borders.repartition(1).write.mode("overwrite").parquet(f"{path}/borders/batch={batch_id}")

    def borders_before(batch_id: int) -> DataFrame:
        known = spark.read.schema(f"{columns}, part INT, batch BIGINT").parquet(f"{path}/borders")
        known = known.filter(F.col("batch") < batch_id)
        drawn = spark.read.schema("batch BIGINT").parquet(f"{path}/drawn").filter(
            F.col("batch") < batch_id).agg(F.max("batch")).first()[0]
        return known.filter(F.col("batch") == drawn).drop("batch")

    def drew(batch_id: int) -> None:
        spark.createDataFrame([(0,)], "x INT").write.mode("overwrite").parquet(
            f"{path}/drawn/batch={batch_id}")

    def with_range(rows: DataFrame, batch_id: int) -> DataFrame:
        """``part``: how many borders a row does not come before."""
        both = rows.withColumn("_border", F.lit(0)).unionByName(
            borders_before(batch_id).drop("part").withColumn("_border", F.lit(1)))
        order_ = [*sort, F.desc("_border")]
        summed = running(order_chunks(both, [], order_), [], order_, {"part": ("sum", F.col("_border"))})
        return summed.filter("_border = 0").select(key, *payload, F.col("part").cast("int").alias("part"))

    def positions(batch_id: int, parts: list[int], keys: DataFrame, name: str) -> DataFrame:
        """(key, name) of those of the keys that are in some ranges before a batch."""
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # of the ranges
        starts = placed.manifest(batch_id).withColumn(
            "_start", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "_start")
        own = Window.partitionBy("part").orderBy(*sort)
        rows = placed.read(batch_id, parts).withColumn("_place", F.row_number().over(own) - 1)
        rows = rows.join(F.broadcast(starts), "part").select(
            key, (F.col("_start") + F.col("_place")).alias(name))
        return rows.join(keys, key, "left_semi")

    if not _written(spark, f"{path}/drawn"):
        state.replace(in_bucket(kept), -1, None)
        draw_ranges(result(state.read(0).drop("part")), -1)
        drew(-1)

    def step(batch: DataFrame, batch_id: int) -> None:
        net = materialize(in_bucket(net_changes(batch, payload, key, order)), "net")
        opened = [r["part"] for r in net.select("part").distinct().collect()]
        before = materialize(state.read(batch_id, opened), "before")
        delta = materialize(settled(net.drop("part"), before, key), "settled")
        write_batch(delta, f"{path}/delta", batch_id)
        after = materialize(overlay(before.drop("part"), delta, payload, key), "after")
        state.replace(in_bucket(after), batch_id, opened)

        keys = delta.select(key)
        side = lambda df, name: result(df.join(keys, key, "left_semi").select(key, *payload)).select(
            key, F.struct(*payload).alias(name))
        both = side(before.drop("part"), "_old").join(side(after, "_new"), key, "full").filter(
            ~F.col("_old").eqNullSafe(F.col("_new")))
        both = materialize(both, "both")
        old = materialize(with_range(both.filter("_old IS NOT NULL").select(key, "_old.*"), batch_id), "old")
        new = materialize(with_range(both.filter("_new IS NOT NULL").select(key, "_new.*"), batch_id), "new")
        touched = [r["part"] for r in old.union(new).select("part").distinct().collect()]
        stay = placed.read(batch_id, touched).join(old.select(key), key, "left_anti")
        placed.replace(stay.unionByName(new), batch_id, touched)
        changed = both.select(key)
        gone = positions(batch_id, touched, changed, "removed_from")
        come = positions(batch_id + 1, touched, changed, "inserted_into")
        diff = gone.join(come, key, "full").fillna(-1, ["removed_from", "inserted_into"])
        write_batch(diff.filter("removed_from <> inserted_into"), f"{path}/diff", batch_id)
        largest = placed.manifest(batch_id + 1).agg(F.max("n")).first()[0] or 0
        if largest > 4 * rows_per_range:
            draw_ranges(materialize(placed.read(batch_id + 1).drop("part"), "drawn"), batch_id)
            drew(batch_id)

    return run_available(changes.writeStream.foreachBatch(step), checkpoint, spark)


def _written(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def live_state(base: DataFrame, path: str, payload: list[str], key: str = "key",
               before_batch: int | None = None) -> DataFrame:
    """``base`` after all deltas, or after those before a batch."""
    if before_batch == 0:
        return base
    kept = base.select(key, *payload).schema
    schema = T.StructType([*kept.fields, T.StructField("op", T.StringType()),
                           T.StructField("batch", T.LongType())])
    deltas = base.sparkSession.read.schema(schema).parquet(f"{path}/delta")
    if before_batch is not None:
        deltas = deltas.filter(F.col("batch") < before_batch)
    last = deltas.groupBy(key).agg(F.max_by(F.struct("op", *payload), "batch").alias("c"))
    return overlay(base, last.select(key, "c.*"), payload, key)
