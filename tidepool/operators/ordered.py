"""Ordered computations that never put an unbounded key into one task.

A plain ``Window.partitionBy(key)`` sorts all rows of a key in one task, and a window without a key
sorts the whole table in one.  The largest key is therefore measured first.  While it fits a task,
plain windows are used.  Otherwise rows are range-partitioned by (keys, order) into balanced chunks,
written once, and every chunk is worked on by itself.  What crosses a chunk border is one row per
chunk (a running total, or the neighbouring row), so the table joined back has at most two rows per
chunk and is safe to broadcast whatever the size of the data.

``keys + order`` must identify a row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.storage import materialize

CHUNK = "_chunk"
MIN_ROWS, MAX_ROWS = 2_000, 4_000_000
MAX_KEY_ROWS = 1_000_000
TASK_ROWS = 500_000
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_LOCAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def chunk_count(rows: int, partitions: int) -> int:
    """As many chunks as there are shuffle partitions, fewer for a small table and more for a table
    whose chunks would otherwise exceed MAX_ROWS rows."""
    return max(1, min(partitions, math.ceil(rows / MIN_ROWS)), math.ceil(rows / MAX_ROWS))


def order_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                 chunks: int | None = None) -> DataFrame:
    """The rows, ready for the functions below, from a table in the shared folder.

    If no key has more than MAX_KEY_ROWS rows they are returned as they are.  Otherwise they are cut
    into balanced chunks in (keys, order) sequence, named by the column CHUNK.

    The input is written first: measuring it and sampling its range then read that table, and what
    produced it runs once.  Pass only the columns that are needed.
    """
    df = materialize(df, "staged")
    if chunks is None:
        if keys:
            sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            if (sizes.agg(F.max("n")).first()[0] or 0) <= MAX_KEY_ROWS:
                return df
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunks = chunk_count(df.count(), partitions)
    ranged = df.repartitionByRange(chunks, *keys, *order)
    return materialize(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _groups(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [CHUNK, *keys] if CHUNK in df.columns else list(keys)


def _local(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*_groups(df, keys)).orderBy(*order)


def _at_border(side: DataFrame, main: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition (chunk, keys), treating null keys as equal."""
    cond = main[CHUNK] == side["_c"]
    for k in keys:
        cond = cond & main[k].eqNullSafe(side[f"_k_{k}"])
    return cond


def _key_struct(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"_k_{k}") for k in keys]) if keys else F.lit(0)


def _spread_key(df: DataFrame, keys: Sequence[str], column: str = "_key") -> DataFrame:
    return df.select("*", *[F.col(f"{column}._k_{k}").alias(f"_k_{k}") for k in keys])


def running(chunked: DataFrame, keys: Sequence[str], order: Sequence[str],
            folds: Mapping[str, tuple[str, Column]], reverse: bool = False,
            exclusive: bool = False) -> DataFrame:
    """Add running folds per key: ``{name: ("sum"|"count"|"min"|"max", value)}``.

    ``reverse`` folds from the last row back (a growing frame over the descending order; a frame up
    to the last row would start anew for every row).  ``exclusive`` leaves the current row out,
    giving 0 for sums and counts and null for min and max at the start.
    """
    way = [F.desc(c) for c in order] if reverse else order
    window = _local(chunked, keys, way).rowsBetween(Window.unboundedPreceding,
                                                    -1 if exclusive else 0)
    main = chunked.select("*", *[_LOCAL[kind](value).over(window).alias(f"_f_{name}")
                                 for name, (kind, value) in folds.items()])
    if CHUNK not in chunked.columns:
        zero = exclusive and [n for n, (kind, _) in folds.items() if kind in ("sum", "count")] or []
        return main.select(*chunked.columns, *[
            (F.coalesce(f"_f_{n}", F.lit(0)) if n in zero else F.col(f"_f_{n}")).alias(n)
            for n in folds])

    totals = chunked.groupBy(CHUNK, *keys).agg(
        *[_LOCAL[kind](value).alias(f"_t_{name}") for name, (kind, value) in folds.items()])
    folded = F.struct(*[F.col(f"_t_{name}") for name in folds])
    key = _key_struct(keys)
    borders = totals.groupBy(CHUNK).agg(
        F.min(key).alias("_first"), F.max(key).alias("_last"),
        F.min_by(folded, key).alias("_first_t"), F.max_by(folded, key).alias("_last_t"))
    # What enters a chunk comes from the nearest rows outside it: the totals of the preceding
    # chunks' last keys, or, in reverse, of the following chunks' first keys.
    give, take = ("_first", "_last") if reverse else ("_last", "_first")
    given = borders.select(F.col(CHUNK).alias("_c"), F.col(give).alias("_key"),
                           F.col(f"{give}_t").alias("_t"), F.lit(False).alias("_probe"))
    probes = borders.select(F.col(CHUNK).alias("_c"), F.col(take).alias("_key"),
                            F.lit(None).cast(given.schema["_t"].dataType).alias("_t"),
                            F.lit(True).alias("_probe"))
    step = F.desc("_c") if reverse else F.asc("_c")
    before = Window.partitionBy("_key").orderBy(step, F.desc("_probe")).rowsBetween(
        Window.unboundedPreceding, -1)
    carry = given.unionByName(probes).select(
        "_c", "_key", "_probe",
        *[_MERGE[kind](F.col(f"_t._t_{name}")).over(before).alias(f"_i_{name}")
          for name, (kind, _) in folds.items()]).filter("_probe").drop("_probe")
    carry = _spread_key(carry, keys).drop("_key")

    joined = main.join(F.broadcast(carry), _at_border(carry, main, keys), "left")
    out = []
    for name, (kind, _) in folds.items():
        here, entered = F.col(f"_f_{name}"), F.col(f"_i_{name}")
        if kind == "min":
            value = F.least(here, entered)
        elif kind == "max":
            value = F.greatest(here, entered)
        elif kind == "count" or exclusive:
            value = F.coalesce(here, F.lit(0)) + F.coalesce(entered, F.lit(0))
        else:
            value = F.coalesce(here + entered, here, entered)
        out.append(value.alias(name))
    return joined.select(*[chunked[c] for c in chunked.columns], *out)


def shift(chunked: DataFrame, keys: Sequence[str], order: Sequence[str],
          values: Mapping[str, Column], forward: bool = True) -> DataFrame:
    """Add the values of the previous row of the key (or the next one, ``forward=False``).

    Each output is a struct ``{v}``, null where the key has no such row, so a null value and a
    missing neighbour stay apart.
    """
    boxed = {name: F.struct(value.alias("v")) for name, value in values.items()}
    window = _local(chunked, keys, order)
    move = F.lag if forward else F.lead
    if CHUNK not in chunked.columns:
        return chunked.select("*", *[move(box).over(window).alias(name)
                                     for name, box in boxed.items()])
    main = chunked.select("*", *[move(box).over(window).alias(f"_s_{name}")
                                 for name, box in boxed.items()])
    position = F.struct(*[F.col(c) for c in [*keys, *order]])
    pick, edge = (F.max_by, F.max) if forward else (F.min_by, F.min)
    edges = chunked.groupBy(CHUNK).agg(
        pick(_key_struct(keys), position).alias("_key"),
        *[pick(box, position).alias(f"_b_{name}") for name, box in boxed.items()])
    chunk_order = Window.partitionBy(F.lit(0)).orderBy(CHUNK)
    target = (F.lead if forward else F.lag)(CHUNK).over(chunk_order)
    edges = _spread_key(edges.select(target.alias("_c"), "_key", *[f"_b_{n}" for n in boxed]),
                        keys).drop("_key").filter("_c IS NOT NULL")
    joined = main.join(F.broadcast(edges), _at_border(edges, main, keys), "left")
    return joined.select(*[chunked[c] for c in chunked.columns],
                         *[F.coalesce(f"_s_{n}", f"_b_{n}").alias(n) for n in boxed])


def row_numbers(df: DataFrame, order: Sequence[str], name: str = "pos",
                chunks: int | None = None) -> DataFrame:
    """0-based position of every row in one global order."""
    parts = order_chunks(df, [], order, chunks)
    return running(parts, [], order, {name: ("count", F.lit(1))}, exclusive=True).drop(CHUNK)


def prefix_sum(df: DataFrame, order: Sequence[str], value: Column, name: str,
               chunks: int | None = None) -> DataFrame:
    """Sum of ``value`` over all earlier rows in one global order."""
    parts = order_chunks(df, [], order, chunks)
    return running(parts, [], order, {name: ("sum", value)}, exclusive=True).drop(CHUNK)


def runs(chunked: DataFrame, keys: Sequence[str], order: Sequence[str], same: Sequence[str],
         name: str = "run_id") -> DataFrame:
    """Number the runs of equal ``same`` values within each key, from 1."""
    marked = shift(chunked, keys, order, {"_prev": F.struct(*[F.col(c) for c in same])})
    now = F.struct(F.struct(*[F.col(c) for c in same]).alias("v"))
    starts = marked.withColumn("_start", F.when(F.col("_prev").eqNullSafe(now), 0).otherwise(1)
                               ).drop("_prev")
    return running(starts, keys, order, {name: ("sum", F.col("_start"))}).drop("_start")


# --- greedy selection -----------------------------------------------------------------------
#
# Start with the first row of a key; the next start is the first later row whose ``hi`` exceeds
# the start's ``lo`` by more than ``limit``.  Throttling (lo = hi = time) and filling packets up to
# a size (lo, hi = bytes before and after the row) are both this rule.  A chunk is entered with the
# ``lo`` of the last start before it.  Which of its rows is then the first start decides the rest
# of the chunk, and different first starts soon fall onto the same sequence, so a chunk is
# summarised by a short list "entered with lo <= x -> leaves with lo y".


def _next_starts(lo: np.ndarray, hi: np.ndarray, limit: int) -> np.ndarray:
    following = np.arange(1, len(lo) + 1)
    return np.maximum(np.searchsorted(hi, lo + limit, side="right"), following)


def _last_starts(nxt: np.ndarray) -> np.ndarray:
    """For each row taken as a start, the last start of the chunk that follows from it."""
    here = np.arange(len(nxt))
    leads = np.where(nxt < len(nxt), nxt, here)
    while True:
        further = leads[leads]
        if (further == leads).all():
            return leads
        leads = further


def greedy_starts(chunked: DataFrame, keys: Sequence[str], order: Sequence[str], lo: str, hi: str,
                  limit: int, name: str = "is_start") -> DataFrame:
    """Flag the starts chosen by the greedy rule; ``lo`` and ``hi`` are non-decreasing integers."""
    sequence = list(dict.fromkeys([hi, *order]))
    if CHUNK in chunked.columns:
        entered = _with_entries(chunked, keys, sequence, lo, hi, limit).withColumn(
            "_task", F.col(CHUNK))
    else:  # many small keys share a task
        tasks = max(1, math.ceil(chunked.count() / TASK_ROWS))
        entered = chunked.select("*", F.lit(None).cast("long").alias("_enter"),
                                 F.pmod(F.xxhash64(*keys), F.lit(tasks)).alias("_task"))
    out_type = T.StructType([*chunked.schema.fields, T.StructField(name, T.BooleanType())])

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        key_no = pdf.groupby(list(keys), dropna=False, sort=False).ngroup() if keys else 0
        pdf = pdf.assign(_key_no=key_no).sort_values(["_key_no", *sequence], kind="stable")
        lows, highs = pdf[lo].to_numpy("int64"), pdf[hi].to_numpy("int64")
        enters, numbers = pdf["_enter"].to_numpy(), pdf["_key_no"].to_numpy()
        flags = np.zeros(len(pdf), dtype=bool)
        edges = np.flatnonzero(np.diff(numbers, prepend=-1, append=-1))
        for first, behind in zip(edges[:-1], edges[1:]):
            low, high = lows[first:behind], highs[first:behind]
            at, enter = 0, enters[first]
            if not pd.isna(enter):
                at = int(np.searchsorted(high, int(enter) + limit, side="right"))
            nxt = _next_starts(low, high, limit)
            while at < len(nxt):
                flags[first + at] = True
                at = int(nxt[at])
        return pdf.assign(**{name: flags})[out_type.fieldNames()]

    return entered.groupBy("_task").applyInPandas(mark, out_type)


def _with_entries(chunked: DataFrame, keys: Sequence[str], sequence: list[str], lo: str, hi: str,
                  limit: int) -> DataFrame:
    """Add ``_enter``: the ``lo`` of the last start before the row's chunk, null if there is none."""
    groups = [CHUNK, *keys]
    key_fields = [T.StructField(k, chunked.schema[k].dataType) for k in keys]
    summary_type = T.StructType([
        T.StructField(CHUNK, T.IntegerType()), *key_fields, T.StructField("upto", T.LongType()),
        T.StructField("leave", T.LongType())])

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(sequence, kind="stable")
        lows, highs = pdf[lo].to_numpy("int64"), pdf[hi].to_numpy("int64")
        leaves = lows[_last_starts(_next_starts(lows, highs, limit))]
        # Entered with lo x, the first start is the first row with hi > x + limit.  Nothing is
        # entered with more than the chunk's own first lo, so later rows need no entry.
        upto = highs - limit - 1
        reach = int(np.searchsorted(upto, lows[0], side="left")) + 1
        upto, leaves = upto[:reach], leaves[:reach]
        keep = np.append(leaves[1:] != leaves[:-1], True)
        head = {CHUNK: pdf[CHUNK].iloc[0], **{k: pdf[k].iloc[0] for k in keys}}
        return pd.DataFrame({**head, "upto": upto[keep], "leave": leaves[keep]})[
            summary_type.fieldNames()]

    # Only keys that continue over a chunk border need an entry value.
    narrow = chunked.select(CHUNK, *dict.fromkeys([*keys, *sequence, lo]))
    spans = chunked.select(*groups).distinct()
    key = _key_struct(keys)
    edges = spans.groupBy(CHUNK).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    crossing = (edges.select(CHUNK, F.explode(F.array("_first", "_last")).alias("_key")).distinct()
                if keys else edges.select(CHUNK, F.lit(0).alias("_key")))
    crossing = _spread_key(crossing, keys).select(F.col(CHUNK).alias("_c"),
                                                  *[f"_k_{k}" for k in keys])
    bordering = narrow.join(F.broadcast(crossing), _at_border(crossing, narrow, keys), "left_semi")
    summary = materialize(bordering.groupBy(*groups).applyInPandas(summarise, summary_type),
                          "greedy")
    entry_type = T.StructType([T.StructField(CHUNK, T.IntegerType()), *key_fields,
                               T.StructField("enter", T.LongType())])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, state = [], None
        for chunk, part in pdf.sort_values([CHUNK, "upto"], kind="stable").groupby(CHUNK):
            if state is not None:
                rows.append({CHUNK: chunk, **{k: pdf[k].iloc[0] for k in keys}, "enter": state})
            upto, leave = part["upto"].to_numpy(), part["leave"].to_numpy()
            at = 0 if state is None else int(np.searchsorted(upto, state, side="left"))
            if at < len(leave):
                state = int(leave[at])
        return pd.DataFrame(rows, columns=entry_type.fieldNames())

    walker = summary.withColumn("_all", F.lit(0)).groupBy(*(keys or ["_all"]))
    entries = materialize(walker.applyInPandas(walk, entry_type), "entries")
    entry = entries.select(F.col(CHUNK).alias("_c"), *[F.col(k).alias(f"_k_{k}") for k in keys],
                           F.col("enter").alias("_enter"))
    return chunked.join(F.broadcast(entry), _at_border(entry, chunked, keys), "left").select(
        *[chunked[c] for c in chunked.columns], "_enter")
