"""Rates, bursts, idleness and packets of event tables; times are integer microseconds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators.ordered import CHUNK, greedy_starts, order_chunks, running, shift


def flow_rate(df: DataFrame, ts: str, seconds: int, metric: Column | None = None,
              keys: Sequence[str] = ()) -> DataFrame:
    """(window, rate): the metric per second in each tick that saw an element.

    The same expression serves tables and streams.
    """
    metric = F.lit(1) if metric is None else metric
    return df.groupBy(*keys, F.window(ts, f"{seconds} seconds")).agg(
        (F.sum(metric) / F.lit(seconds)).alias("rate"))


def debounce(df: DataFrame, keys: Sequence[str], us: str, tie: str, wait_us: int) -> DataFrame:
    """The last event of every burst, with ``fired_us``; a burst ends when nothing follows within
    the wait."""
    parts = order_chunks(df, keys, [us, tie])
    seen = shift(parts, keys, [us, tie], {"_next": F.col(us)}, forward=False)
    last = F.col("_next").isNull() | (F.col("_next.v") - F.col(us) > wait_us)
    return seen.filter(last).drop("_next", CHUNK).withColumn("fired_us", F.col(us) + wait_us)


def throttle(df: DataFrame, keys: Sequence[str], us: str, tie: str | Sequence[str],
             wait_us: int) -> DataFrame:
    """The first event, then the first one at least ``wait_us`` after the last one passed on."""
    order = [us, tie] if isinstance(tie, str) else [us, *tie]
    parts = order_chunks(df, keys, order)
    marked = greedy_starts(parts, keys, order, us, us, wait_us - 1)
    return marked.filter("is_start").drop("is_start", CHUNK)


def idle_sessions(df: DataFrame, keys: Sequence[str], us: str, tie: str,
                  idle_us: int = 60_000_000) -> DataFrame:
    """(keys, session, active_us, idle_us, n): activity from the first event after idleness until
    ``idle_us`` after the last."""
    parts = order_chunks(df, keys, [us, tie])
    seen = shift(parts, keys, [us, tie], {"_prev": F.col(us)})
    fresh = F.col("_prev").isNull() | (F.col(us) - F.col("_prev.v") > idle_us)
    flagged = seen.withColumn("_new", F.when(fresh, 1).otherwise(0)).drop("_prev")
    numbered = running(flagged, keys, [us, tie], {"session": ("sum", F.col("_new"))})
    return numbered.groupBy(*keys, "session").agg(
        F.min(us).alias("active_us"), (F.max(us) + idle_us).alias("idle_us"),
        F.count(F.lit(1)).alias("n"))


def event_packets(df: DataFrame, order: str, body: Column, max_bytes: int = 4000) -> DataFrame:
    """Fill packets in order: rows with ``packet`` (from 1) and their ``bytes``.

    A packet takes events until the next one would exceed ``max_bytes``; an event larger than that
    is a packet of its own.
    """
    sized = df.withColumn("bytes", F.octet_length(body).cast("long"))
    parts = order_chunks(sized, [], [order])
    placed = running(parts, [], [order], {"_hi": ("sum", F.col("bytes"))}).withColumn(
        "_lo", F.col("_hi") - F.col("bytes"))
    marked = greedy_starts(placed, [], [order], "_lo", "_hi", max_bytes)
    flagged = marked.withColumn("_new", F.col("is_start").cast("int"))
    return running(flagged, [], [order], {"packet": ("sum", F.col("_new"))}).drop(
        CHUNK, "_lo", "_hi", "_new", "is_start")
