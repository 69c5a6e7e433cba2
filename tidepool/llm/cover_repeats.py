"""Removal of repeated word windows with difference-cover anchors.

A difference cover of a period holds, for every shift, two places that are that shift apart.  So any
two equal windows, wherever they begin, have some place in common that is a cover position in both
documents, and it is enough to hash the grams at cover positions:

* Grams that occur once rule their windows out; grams are counted with partial sums first, so a
  frequent one gathers nowhere.
* Around each gram that occurs again stands its context, all windows that hold the gram at that place.
  A context that occurs again repeats as a whole.
* Contexts that occur once are extended against the other contexts of their gram, one of each kind:
  for every offset of a window from the anchor, equal windows share a hash.  Grams with very many
  kinds are spread by offset and window, so no task has to hold them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.batches import SequenceHash, lean, lean_group, mix, whole_texts, word_runs
from tidepool.storage import materialize, narrow_join, sized_join

NO_ID = -(1 << 63)
_SHIFT = 20
_U = np.uint64


@dataclass(frozen=True)
class CoverSettings:
    """``cover`` is a difference cover of ``period``; windows must be at least as long as that.

    The default cover is perfect: every shift of 1 to 20 is the difference of one pair of places.
    """

    window: int = 35
    period: int = 21
    cover: tuple[int, ...] = (0, 1, 4, 14, 16)
    hot_kinds: int = 4096          # contexts of one gram that are compared in one task
    task_kinds: int = 50_000       # contexts of all grams of such a task

    def __post_init__(self):
        shifts = {(a - b) % self.period for a in self.cover for b in self.cover}
        if shifts != set(range(self.period)):
            raise ValueError("the cover leaves out some shift of its period")
        if self.gram < 1 or self.window + self.period >= 1 << _SHIFT:
            raise ValueError("a window must be at least as long as the period")

    @property
    def reach(self) -> int:
        """Offsets at which a window can hold an anchor, less one."""
        return self.period - 1

    @property
    def gram(self) -> int:
        return self.window - self.reach


def _anchors(bounds: np.ndarray, s: CoverSettings) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of the cover positions of some texts whose words stand end to end."""
    lengths = np.diff(bounds)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(bounds[-1]) - bounds[row]
    covered = np.zeros(s.period, bool)
    covered[list(s.cover)] = True
    fits = (place + s.gram <= lengths[row]) & (lengths[row] >= s.window)
    at = np.flatnonzero(covered[place % s.period] & fits)
    return row[at], at


def _gram_rows(docs: DataFrame, s: CoverSettings, located: bool) -> DataFrame:
    """``g``, the gram's hash at every cover position; located ones with ``c, k, h, p``: the hash of
    the context, the text and the position."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, bounds in word_runs(batch.column(0)):
                row, at = _anchors(bounds, s)
                if not len(at):
                    continue
                hashes = SequenceHash(words)
                columns = [_signed(hashes.spans(at, at + s.gram))]
                if located:
                    low = np.maximum(bounds[row], at - s.reach)
                    high = np.minimum(bounds[row + 1], at + s.window)
                    context = mix(hashes.spans(low, high) + (at - low).astype(_U))
                    whose = pa.array(row + first)
                    columns += [_signed(context), *(batch.column(i).take(whose) for i in (1, 2)),
                                pa.array((at - bounds[row]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["g", "c", "k", "h", "p"][:len(columns)])

    rows = docs.select(F.col("text").cast("binary"), *(["k", "h"] if located else []))
    return rows.mapInArrow(lean(find), "g long, c long, k long, h long, p int" if located else "g long")


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _window_hashes(texts: DataFrame, s: CoverSettings) -> DataFrame:
    """``wanted`` anchors (of each text, with their grams) and the hashes of the windows around them,
    from the one that begins at the anchor backwards; null where a window leaves the text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, bounds in word_runs(batch.column(0)):
                part = batch.slice(first, len(bounds) - 1)
                wanted = part.column(3)
                of = np.repeat(np.arange(len(part)), wanted.value_lengths().to_numpy())
                flat = wanted.flatten()
                p = flat.field("p").to_numpy().astype(np.int64)
                if not len(p):
                    continue
                begin = bounds[of][:, None] + p[:, None] - np.arange(s.period)
                inside = (begin >= bounds[of][:, None]) & (
                    begin + s.window <= bounds[of + 1][:, None])
                begin = np.where(inside, begin, 0)
                hashes = SequenceHash(words)
                end = np.minimum(begin + s.window, len(words))
                found = hashes.spans(begin.ravel(), end.ravel())
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(p) + 1, dtype=np.int32) * s.period),
                    pa.array(found.view(np.int64), mask=~inside.ravel()))
                whose = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [flat.field("g"), part.column(1).take(whose), part.column(2).take(whose),
                     flat.field("p"), flat.field("once"), lists],
                    ["g", "k", "h", "p", "once", "windows"])

    return texts.select("t", "k", "h", "wanted").mapInArrow(
        lean(cut), "g long, k long, h long, p int, once boolean, windows array<bigint>")


def _extended(kinds: DataFrame, s: CoverSettings) -> DataFrame:
    """``k, h, start, end``: the windows of contexts that occur once which others of their gram share.

    Grams with at most ``hot_kinds`` contexts are compared whole, many in a task.
    """
    tasks = int(kinds.count() // s.task_kinds + 1)

    def compare(table: pa.Table) -> pa.Table:
        g, p = table["g"].to_numpy(), table["p"].to_numpy()
        once = table["once"].to_numpy(zero_copy_only=False)
        lists = table["windows"].combine_chunks()
        known = np.array(lists.flatten().is_valid()).reshape(len(g), -1)
        hashes = lists.flatten().fill_null(0).to_numpy().reshape(len(g), -1)
        rows, starts = [], []
        for offset in range(hashes.shape[1] if len(g) else 0):
            some = np.flatnonzero(known[:, offset])
            order = some[np.lexsort((hashes[some, offset], g[some]))]
            same = (g[order[1:]] == g[order[:-1]]) & (
                hashes[order[1:], offset] == hashes[order[:-1], offset])
            again = order[np.append(False, same) | np.append(same, False)] if len(order) else order
            again = again[once[again]]
            rows.append(again)
            starts.append(p[again] - offset)
        rows = np.concatenate([np.zeros(0, np.int64), *rows])
        starts = np.concatenate([np.zeros(0, np.int32), *starts]).astype(np.int32)
        return pa.table({"k": table["k"].take(pa.array(rows)), "h": table["h"].take(pa.array(rows)),
                         "start": starts, "end": (starts + s.window).astype(np.int32)})

    dealt = kinds.withColumn("task", F.pmod(F.xxhash64("g", F.lit("task")), F.lit(tasks)))
    return dealt.groupBy("task").applyInArrow(lean_group(compare), "k long, h long, start int, end int")


def _extended_hot(kinds: DataFrame, s: CoverSettings) -> DataFrame:
    """The same for grams with any number of contexts, one row for each window."""
    each = kinds.select("g", "k", "h", "p", "once", F.posexplode("windows").alias("offset", "window"))
    each = each.filter("window is not null")
    shared = each.groupBy("g", "offset", "window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = each.filter("once").join(shared.drop("n"), ["g", "offset", "window"])
    start = F.col("p") - F.col("offset")
    return found.select("k", "h", start.alias("start"), (start + s.window).alias("end"))


def repeated_windows(docs: DataFrame, s: CoverSettings) -> DataFrame:
    """``k, h, spans``: for every text (by id and hash) the word spans that its repeated windows cover.

    A span is one long: its first word, from ``_SHIFT`` up, and its length in the lowest bits.  Spans
    may overlap and, at the ends, reach beyond the text by less than a window.
    """
    counted = _gram_rows(whole_texts(docs), s, False).groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    twice = materialize(counted.filter("n > 1").select("g"), "grams")
    again = materialize(_gram_rows(docs, s, True).join(twice, "g"), "again")

    contexts = again.groupBy("g", "c").agg(F.count(F.lit(1)).alias("n"),
                                           F.min(F.struct("k", "h", "p")).alias("at"))
    contexts = materialize(contexts, "contexts")
    kinds = contexts.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"),
                                      F.max(F.col("n") == 1).alias("open"))
    several = contexts.join(kinds.filter("kinds > 1 and open").drop("open"), "g")
    several = materialize(several.select("g", "kinds", (F.col("n") == 1).alias("once"), "at.*"),
                          "several")

    # a context that occurs again: all windows around it do
    alike = contexts.filter("n > 1").select("g", "c")
    whole = again.join(alike, ["g", "c"]).select(
        "k", "h", (F.col("p") - s.reach).alias("start"), (F.col("p") + s.window).alias("end"))

    wanted = several.groupBy("k", "h").agg(F.collect_list(F.struct("g", "p", "once")).alias("wanted"))
    # equal rows give their windows more than once, which changes nothing: none of them occurs once
    texts = docs.select("k", "h", F.col("text").cast("binary").alias("t"))
    windows = _window_hashes(narrow_join(texts, wanted, ["k", "h"]), s)
    hot = several.filter(F.col("kinds") > s.hot_kinds)
    if hot.isEmpty():
        found = whole.unionByName(_extended(windows, s))
    else:
        windows = materialize(windows, "windows")
        grams = materialize(hot.select("g").distinct(), "hot")
        rest = sized_join(windows, grams, ["g"], spread="p", how="left_anti")
        hot = sized_join(windows, grams, ["g"], spread="p", how="left_semi")
        found = whole.unionByName(_extended(rest, s)).unionByName(_extended_hot(hot, s))
    packed = F.shiftleft(F.col("start").cast("long"), _SHIFT) + (F.col("end") - F.col("start"))
    return found.groupBy("k", "h").agg(F.collect_set(packed).alias("spans"))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"),
                       F.xxhash64(text).alias("h"))


def _kept(words: list[bytes], spans: pa.Scalar) -> list[bytes]:
    if spans.values is None or not len(spans.values):
        return words
    mark = np.zeros(len(words) + 1, np.int64)
    packed = spans.values.to_numpy()
    start = packed >> _SHIFT
    end = (start + (packed & ((1 << _SHIFT) - 1))).clip(0, len(words))
    start = start.clip(0, len(words))
    np.add.at(mark, start, 1)
    np.add.at(mark, end, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0)]


def window_digest(docs: DataFrame, settings: CoverSettings | None = None) -> DataFrame:
    """One row per row: ``doc_id, n_words, n_removed, kept_sha256`` of the removal.

    A word goes if a window of ``window`` words that covers it also starts anywhere else, the same
    document included; windows are judged on the input and never cross documents.  Words are runs of
    bytes other than ASCII white space, unchanged.  A null text counts as empty.  Equal rows are
    documents of their own, so their windows repeat; rows that share an id are told apart by a hash of
    their text.  Other columns are not looked at.  Words and windows are compared by 64-bit hashes,
    windows within one gram and offset.
    """
    s = settings or CoverSettings()
    keyed = _keyed(docs.select("doc_id", "text"))
    rows = narrow_join(keyed.select("doc_id", "k", "h", F.col("text").cast("binary").alias("t")),
                       repeated_windows(keyed, s), ["k", "h"], "left")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or b"").split()
                kept = _kept(words, spans)
                out.append((len(words), len(words) - len(kept),
                            hashlib.sha256(b" ".join(kept)).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c) for c in zip(*out))],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return rows.select(F.col("doc_id").cast("long"), "t", "spans").mapInArrow(
        lean(digest), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeated_windows(docs: DataFrame, settings: CoverSettings | None = None) -> DataFrame:
    """``docs`` with repeated windows cut out of ``text``; see :func:`window_digest`.

    The words that stay are joined by single blanks if any word went; other texts are unchanged.  All
    rows and columns stay, whatever their names; a null text stays null.
    """
    s = settings or CoverSettings()
    names = [f"_c{i}" for i in range(len(docs.columns))]
    known = dict(zip(docs.columns, names))
    held = docs.toDF(*names)
    keyed = _keyed(held.select(*names, F.col(known["doc_id"]).alias("doc_id"),
                               F.col(known["text"]).alias("text")))
    spans = repeated_windows(keyed.select("doc_id", "text", "k", "h"), s)
    rows = narrow_join(keyed, spans, ["k", "h"], "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        lists = pa.array([None if x is None else list(x) for x in spans], pa.list_(pa.int64()))
        return pd.Series([None if t is None else b" ".join(_kept(t.encode().split(), x)).decode()
                          for t, x in zip(texts, lists)], dtype=object)

    shortened = F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut("text", "spans"))
    return rows.select(*[(shortened if c == "text" else F.col(known[c])).alias(c)
                         for c in docs.columns])
