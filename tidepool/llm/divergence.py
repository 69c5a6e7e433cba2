"""Audit of how far sources diverge, with hash-consed segment trees over term ids.

The terms of a language get ids, the most widespread first, and are cut into chunks of neighbouring
ids.  For a chunk, the counts of a group (language and source) are the leaves of a segment tree.
Equal subtrees, of one group or of several, are one node, so a chunk that most groups lack costs next
to nothing.  Two trees are compared by walking them together, level by level: each pair of nodes that
is met for a pair of groups is priced once, however often it occurs.  Chunks add up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.storage import materialize

SCALE = 1_000_000_000
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_PIECE = 4 << 20
_HELD = 200_000     # counts that a task holds before it passes them on


@dataclass(frozen=True)
class DivergenceSettings:
    min_documents: int = 30       # of a language that have a term
    smoothing: int = 5            # occurrences that every kept term is given
    top_terms: int = 50
    chunk: int = 1024             # term ids of a tree, a power of two
    sources: int = 64             # of a language in one block; every two blocks of them meet in a task
    pairs: int = 512              # of groups that are walked at once


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces that do not cut a term."""
    at = 0
    while at < len(raw):
        cut = _BREAK.search(raw, at + _PIECE) if at + _PIECE < len(raw) else None
        end = cut.end() if cut else len(raw)
        yield raw[at:end]
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that have the term.

    Terms are runs of ASCII letters and of whatever is not ASCII; only A-Z are lower-cased.  Null
    texts, languages and sources are empty ones.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def flush():
            parts = [(lang, source, term, n, docs[term]) for (lang, source), (counts, docs)
                     in held.items() for term, n in counts.items()]
            lang, source, term, n, docs = zip(*parts)
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(source, pa.string()),
                 pa.array(term, pa.binary()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)),
                                          batch.column(2)):
                counts, with_term = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(counts)
                own = Counter()
                for piece in _pieces(text.as_py().lower()):
                    own.update(TERM.findall(piece))
                counts.update(own)
                with_term.update(own.keys())
                size += len(counts) - before
                if size >= _HELD:
                    yield flush()
                    held, size = {}, 0
        if size:
            yield flush()

    blank = F.lit("")
    rows = docs.select(F.coalesce("lang", blank), F.coalesce("source", blank),
                       F.coalesce("text", blank).cast("binary"))
    counted = rows.mapInArrow(count, "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column, s: DivergenceSettings) -> Column:
    """1 + floor(SCALE * (count + smoothing) / (total + smoothing * terms)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    top = F.lit(SCALE).cast("decimal(10,0)") * (wide(count) + F.lit(s.smoothing))
    return F.call_function("div", top, wide(total) + wide(terms * F.lit(s.smoothing))) + 1


def _shares(counts: np.ndarray, total: int, terms: int, s: DivergenceSettings) -> np.ndarray:
    below = total + s.smoothing * terms
    return np.array([1 + SCALE * (c + s.smoothing) // below for c in counts.tolist()], np.int64)


def shared_trees(counts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Hash-consed segment trees over the rows of a matrix (a power of two wide).

    Returns the values of the distinct leaves, for each level above them the two children of every
    node, and the root of each row.
    """
    leaves, ids = np.unique(counts, return_inverse=True)
    ids = ids.reshape(counts.shape)
    levels, n = [], len(leaves)
    while ids.shape[1] > 1:
        code, ids = np.unique(ids[:, 0::2] * n + ids[:, 1::2], return_inverse=True)
        levels.append(np.stack([code // n, code % n], 1))
        ids = ids.reshape(len(counts), -1)
        n = len(code)
    return leaves, levels, ids[:, 0]


def walk_together(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, leaf, leaf, times) for pairs of roots: every two leaves that meet, each once a pair."""
    pair, times = np.arange(len(x)), np.ones(len(x), np.int64)
    for children in reversed(levels):
        pair, times = np.tile(pair, 2), np.tile(times, 2)
        x = np.concatenate([children[x, 0], children[x, 1]])
        y = np.concatenate([children[y, 0], children[y, 1]])
        order = np.lexsort((y, x, pair))
        pair, x, y, times = pair[order], x[order], y[order], times[order]
        new = np.append(True, (pair[1:] != pair[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
        times = np.add.reduceat(times, np.flatnonzero(new)) if len(pair) else times
        pair, x, y = pair[new], x[new], y[new]
    return pair, x, y, times


def _priced(table: pa.Table, s: DivergenceSettings) -> pa.Table:
    """The distances that a chunk adds between the groups of two blocks, the smaller source first."""
    table = table.sort_by("source")
    size, terms = table["size"][0].as_py(), table["terms"][0].as_py()
    block, total = table["block"].to_numpy(), table["total"].to_pylist()
    low, high = table["i"][0].as_py(), table["j"][0].as_py()
    counts = np.full((len(block), 1 << max(0, size - 1).bit_length()), -1, np.int64)  # -1: no term
    counts[:, :size] = 0
    lists = table["counts"].combine_chunks()
    of = np.repeat(np.arange(len(block)), lists.value_lengths().fill_null(0).to_numpy())
    flat = lists.flatten()
    counts[of, flat.field("place").to_numpy()] = flat.field("n").to_numpy()
    leaves, levels, roots = shared_trees(counts)
    shares = [np.where(leaves < 0, 0, _shares(leaves, n, terms, s)) for n in total]
    shares = np.stack(shares)
    a, b = np.triu_indices(len(block), 1)
    some = np.minimum(block[a], block[b]) == low
    some &= np.maximum(block[a], block[b]) == high
    a, b = a[some], b[some]
    value = np.zeros(len(a), np.int64)
    for first in range(0, len(a), s.pairs):
        some = slice(first, first + s.pairs)
        pair, x, y, times = walk_together(levels, roots[a[some]], roots[b[some]])
        price = np.abs(shares[a[some][pair], x] - shares[b[some][pair], y]) * times
        np.add.at(value[some], pair, price)
    source = table["source"].combine_chunks()
    return pa.table({"lang": pa.array([table["lang"][0].as_py()] * len(a), pa.string()),
                     "a": source.take(pa.array(a)), "b": source.take(pa.array(b)),
                     "value": pa.array(value)})


def source_divergence(docs: DataFrame, settings: DivergenceSettings | None = None) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source of a language is from the others.

    A language keeps the terms that at least ``min_documents`` of its documents have.  Every group
    gives each kept term the share p = 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers.  In
    part ``pair`` an item is another source of the language and the value the sum of |p - q| over all
    kept terms (0 without any).  In part ``term`` an item is a term that the group has and uses more
    than its language does, the value is p - q, and only ``top_terms`` are returned.  Items are ranked
    by value, then in the order of their UTF-8 bytes.  Null texts, languages and sources count as
    empty; ids are not looked at, so repeated rows count as often as they occur; groups without any
    term take part with counts of zero; an empty table gives no rows.
    """
    s = settings or DivergenceSettings()
    if s.chunk & (s.chunk - 1):
        raise ValueError("chunk must be a power of two")
    docs = docs.select("lang", "source", "text")
    counts = materialize(term_counts(docs), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"))
    kept = kept.filter(F.col("docs") >= s.min_documents)
    # the most widespread terms come first, so that rare ones, which most groups lack, share chunks
    kept = kept.repartitionByRange("lang", F.desc("docs"), "term").sortWithinPartitions(
        "lang", F.desc("docs"), "term").withColumn("id", F.monotonically_increasing_id())
    kept = materialize(kept, "terms")
    langs = materialize(kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("all").alias("lang_total")), "langs")

    found = materialize(counts.join(kept.drop("docs"), ["lang", "term"]).select(
        "lang", "source", "term", "n", "all", "id"), "found")
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"),
                         F.coalesce("source", F.lit("")).alias("source")).distinct()
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").fillna({"total": 0})
    groups = groups.join(langs, "lang", "left").fillna({"terms": 0, "lang_total": 0})
    groups = materialize(groups, "groups")

    out = _term_part(found, groups, s).unionByName(_pair_part(found, kept, groups, s))
    return out.select("lang", "source", "part", "item", "value", "rank")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))


def _term_part(found: DataFrame, groups: DataFrame, s: DivergenceSettings) -> DataFrame:
    rows = found.join(groups, ["lang", "source"])
    more = (share(F.col("n"), F.col("total"), F.col("terms"), s)
            - share(F.col("all"), F.col("lang_total"), F.col("terms"), s))
    rows = rows.select("lang", "source", F.col("term").alias("item"), more.alias("value"))
    ranked = _ranked(rows.filter("value > 0"), "term")
    return ranked.filter(F.col("rank") <= s.top_terms)  # limited before the shuffle as well


def _pair_part(found: DataFrame, kept: DataFrame, groups: DataFrame, s: DivergenceSettings
               ) -> DataFrame:
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / s.sources).cast("int").alias("blocks"))
    groups = groups.join(blocks, "lang")
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(block, other).alias("i"), F.greatest(block, other).alias("j")))
    placed = groups.select("lang", "source", "total", "terms", block.alias("block"),
                           F.explode(cells).alias("cell"))

    # ids run on within a partition of the terms, so a chunk is an aligned range of them
    chunk, place = F.expr(f"id div {s.chunk}"), (F.col("id") % s.chunk).cast("int")
    chunks = kept.groupBy("lang", chunk.alias("chunk")).agg(
        (F.max(place) - F.min(place) + 1).alias("size"), F.min(place).alias("first"))
    chunks = materialize(chunks, "chunks")
    packed = found.withColumn("chunk", chunk).join(chunks, ["lang", "chunk"]).groupBy(
        "lang", "chunk", "source").agg(F.collect_list(F.struct(
            (place - F.col("first")).alias("place"), "n")).alias("counts"))
    rows = placed.join(chunks, "lang").select(
        "lang", "chunk", "source", "total", "terms", "block", "cell.*", "size")
    rows = rows.join(packed, ["lang", "chunk", "source"], "left")
    priced = rows.groupBy("lang", "chunk", "i", "j").applyInArrow(
        lambda table: _priced(table, s), "lang string, a string, b string, value long")
    summed = materialize(priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = summed.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").union(
        summed.select("lang", "b", "a", "value"))
    # a language without kept terms has no chunk: its sources do not differ
    none = groups.filter("terms = 0").select("lang", "source")
    equal = none.join(none.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    return _ranked(both.union(equal.withColumn("value", F.lit(0).cast("long"))), "pair")
