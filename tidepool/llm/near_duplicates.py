"""Near duplicates: a multi-index Hamming join over b-bit MinHash signatures.

A signature has ``chunks * chunk`` values of 16 bits.  If two signatures differ in at most
``chunks * (errors + 1) - 1`` values, then by pigeonhole some chunk differs in at most ``errors``,
and both sides share one of the keys made of that chunk with ``errors`` values left out.  So a join on
the keys meets every pair below the distance threshold.  A longer sketch rules most of the others
out, and links are confirmed on full sets.

Documents with equal sets are one class from the start.  Within a key every class is first paired
with one hub only, the class that shares the most keys.  Classes that hubs have already linked into
one component are never paired again, and what is left is compared block by block, each pair under
the first key that it shares, so a large group of copies costs about one pair each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.batches import lean, lean_group, mix, release_memory, whole_texts, word_runs
from tidepool.llm.components import connected_components
from tidepool.storage import materialize, sized_join

BLOCK = 1000                   # classes of one key that are compared with as many others at once
TASK_ROWS = 20_000             # rows of keys in a group of such comparisons
CELL_BYTES = 32 << 20          # of the sets, each counted for every pair, that are confirmed together
HUB_PAIRS = 2000               # pairs of one class that are confirmed together
NO_ID = -(1 << 63)

_U = np.uint64


@dataclass(frozen=True)
class NearSettings:
    """Two texts with similarity 0.8 miss each other in all chunks about twice in a million times,
    and their sketches differ in more than ``max_bits`` less often than that."""

    shingle_words: int = 5
    similarity_percent: int = 80
    chunks: int = 10
    chunk: int = 5
    errors: int = 1
    functions: int = 512         # of the sketch, which has two bits of each
    max_bits: int = 160

    @property
    def values(self) -> int:
        return self.chunks * self.chunk

    @property
    def max_distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) of runs of rows: sorted distinct 64-bit hashes of each text's shingles.

    A-Z count as a-z.  A text with fewer words than a shingle is one shingle, one without any has an
    empty set.
    """
    for first, word, bounds in word_runs(column, fold=True):
        sets = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            n = b - a
            if n == 0:
                sets.append(np.zeros(0, _U))
                continue
            width = min(n, words)
            h = np.zeros(n - width + 1, _U)
            for k in range(width):
                h = h * _U(0x9FB21C651E98DF25) + word[a + k:b - width + 1 + k]
            sets.append(np.unique(mix(h + _U(width < words))))
        yield first, sets


def least_hashes(sets: list[np.ndarray], functions: int) -> np.ndarray:
    """The least hash of each set under each function, mixed so that any bits of it will do."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    flat = np.concatenate(sets)
    rng = np.random.default_rng(20240229)
    factors = rng.integers(1, 1 << 63, functions, dtype=_U) * _U(2) + _U(1)
    shifts = rng.integers(0, 1 << 63, functions, dtype=_U)
    out = np.empty((len(sets), functions), _U)
    for k in range(functions):
        out[:, k] = np.minimum.reduceat(flat * factors[k] + shifts[k], starts)
    return mix(out.ravel()).reshape(out.shape)


def sketch_bits(least: np.ndarray) -> np.ndarray:
    """Two bits of every value, 64 to a long."""
    pairs = (least >> _U(32)) & _U(3)
    wide = pairs.reshape(len(least), -1, 32) << (_U(2) * np.arange(32, dtype=_U))
    return np.bitwise_or.reduce(wide, axis=2)


def _keys(signatures: np.ndarray, s: NearSettings) -> np.ndarray:
    """One key for every chunk and every choice of values that may differ in it."""
    out = []
    for c in range(s.chunks):
        part = signatures[:, c * s.chunk:(c + 1) * s.chunk]
        for left in combinations(range(s.chunk), s.chunk - s.errors):
            h = np.full(len(part), len(out) + 1, _U)
            for k in left:
                h = h * _U(0x9E3779B97F4A7C15) + part[:, k] + _U(1)
            out.append(mix(h))
    return np.stack(out, 1)


def _lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(rows).ravel().view(np.int64))
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), flat)


def _digest(s: np.ndarray) -> tuple[int, int]:
    a = int(mix(s).sum(dtype=_U))
    b = int(mix(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=_U))
    return a - (1 << 63), b - (1 << 63)


def sketches(docs: DataFrame, settings: NearSettings) -> DataFrame:
    """``doc_id, n_shingles``, a 128-bit digest of the set, its sketch and the keys of its signature."""
    schema = ("doc_id long, n_shingles long, d1 long, d2 long, bits array<bigint>, "
              "keys array<bigint>")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column(1), settings.shingle_words):
                ids = batch.column(0).slice(first, len(sets))
                digests = [_digest(x) for x in sets]
                least = least_hashes([x if len(x) else np.zeros(1, _U) for x in sets],
                                     settings.functions)
                signatures = least[:, :settings.values] & _U(0xFFFF)
                known = pa.array([i if len(x) else None for i, x in enumerate(sets)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([d[0] for d in digests], pa.int64()),
                     pa.array([d[1] for d in digests], pa.int64()),
                     _lists(sketch_bits(least)).take(known),
                     _lists(_keys(signatures, settings)).take(known)],
                    ["doc_id", "n_shingles", "d1", "d2", "bits", "keys"])

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(lean(sketch), schema)


def differing_bits(a: Column, b: Column, settings: NearSettings) -> Column:
    total = F.lit(0)
    for k in range(settings.functions // 32):
        total = total + F.bit_count(a[k].bitwiseXOR(b[k]))
    return total


def _similar_sizes(a: Column, b: Column, s: NearSettings) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * s.similarity_percent


def _close(pairs: DataFrame, classes: DataFrame, s: NearSettings) -> DataFrame:
    """The pairs whose sizes and sketches do not rule a link out."""
    side = lambda c: classes.select(
        F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(_similar_sizes(F.col("n_a"), F.col("n_b"), s)
                       & (differing_bits(F.col("bits_a"), F.col("bits_b"), s) <= s.max_bits)
                       ).select("a", "b")


def _left_pairs(buckets: DataFrame, roots: DataFrame, classes: DataFrame, s: NearSettings
                ) -> DataFrame:
    """Close pairs of classes of one key in different components, found block by block.

    A key with many classes is cut into blocks, and every two of them are a cell.  A pair is
    reported under the first key that it shares, so once.
    """
    placed = buckets.join(roots, "node", "left").select(
        "key", "node", F.coalesce("root", "node").alias("root"))
    several = placed.groupBy("key").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"))
    several = several.filter("lo <> hi").select(
        "key", F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("int").alias("blocks"))
    rows = placed.join(several, "key")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(
        F.least(block, other).alias("i"), F.greatest(block, other).alias("j"),
        (block <= other).alias("first")))
    rows = rows.withColumn("cell", F.explode(cells)).select("key", "cell.*", "node", "root")
    rows = materialize(rows, "cells")
    groups = max(1, rows.count() // TASK_ROWS)
    rows = rows.withColumn("task", F.pmod(F.xxhash64("key", "i", "j"), F.lit(groups)))
    rows = rows.join(classes.select("node", "n_shingles", "bits", "keys"), "node")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("key", "ascending"), ("i", "ascending"),
                                                ("j", "ascending"), ("first", "descending")])
        key, i, j, node, root, n = (table[c].to_numpy() for c in (
            "key", "i", "j", "node", "root", "n_shingles"))
        bits, keys = (_matrix(table[c]) for c in ("bits", "keys"))
        first = table["first"].to_numpy(zero_copy_only=False)
        new = np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(key))
        out_a, out_b = [], []
        for a, b in zip(starts, ends):
            own = i[a] == j[a]
            middle = b if own else a + int(first[a:b].sum())
            for x in range(a, middle):
                others = np.arange(x + 1 if own else middle, b)
                others = others[root[others] != root[x]]
                m = n[others]
                others = others[np.minimum(m, n[x]) * 100 >= np.maximum(m, n[x])
                                * s.similarity_percent]
                if not len(others):
                    continue
                apart = np.bitwise_count(bits[others] ^ bits[x]).sum(1)
                others = others[apart <= s.max_bits]
                shared = keys[others] == keys[x]
                others = others[keys[x, shared.argmax(1)] == key[x]]
                out_a.append(np.minimum(node[others], node[x]))
                out_b.append(np.maximum(node[others], node[x]))
        none = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([none, *out_a]), "b": np.concatenate([none, *out_b])})

    return rows.groupBy("task").applyInArrow(lean_group(compare), "a long, b long")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame, s: NearSettings) -> DataFrame:
    """The pairs of classes whose full sets are similar enough.

    Sets are computed anew from one text of each class and meet their pairs in cells, in each of
    which a set is needed once however many pairs it is in.
    """
    degrees = pairs.groupBy(F.col("a").alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(True).alias("first")).union(pairs.groupBy("b").agg(
            F.count(F.lit(1)), F.lit(False)))
    load = degrees.join(classes.select("node", "n_shingles"), "node").agg(
        F.sum(F.col("n") * F.col("n_shingles")).alias("total"),
        F.max(F.when(F.col("first"), F.col("n"))).alias("most")).first()
    cells = int(8 * (load["total"] or 0) // CELL_BYTES + 1)
    salts = int((load["most"] or 0) // HUB_PAIRS + 1)  # parts of the pairs of a class
    dealt = materialize(pairs.select("a", "b", F.pmod(F.xxhash64(
        "a", F.pmod(F.xxhash64("b"), F.lit(salts))), F.lit(cells)).alias("cell")), "dealt")
    needed = dealt.select("cell", F.col("a").alias("node")).union(dealt.select("cell", "b")).distinct()
    sets = _full_sets(docs, classes, needed, s)

    def confirm(_, pairs: pa.Table, sets: pa.Table) -> pa.Table:
        if not pairs.num_rows or not sets.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        held = {k: np.frombuffer(x.as_py(), _U) for k, x in zip(
            sets["node"].to_pylist(), sets["shingles"])}
        a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
        good = np.zeros(len(a), bool)
        for row, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            small, large = sorted((held[x], held[y]), key=len)
            at = np.searchsorted(large, small)
            shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
            good[row] = 100 * shared >= s.similarity_percent * (len(small) + len(large) - shared)
        held.clear()
        release_memory()
        return pa.table({"a": a[good], "b": b[good]})

    return dealt.groupBy("cell").cogroup(sets.groupBy("home")).applyInArrow(
        confirm, "a long, b long")


def _full_sets(docs: DataFrame, classes: DataFrame, needed: DataFrame, s: NearSettings) -> DataFrame:
    """``home, node, shingles`` (sorted 64-bit hashes) for the cells and classes that are ``needed``,
    from one text of each class."""
    wanted = materialize(needed.join(classes, "node").select(
        F.col("cell").alias("home"), "node", "d1", "d2",
        F.coalesce("min_id", F.lit(NO_ID)).alias("k")), "wanted")
    keyed = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("k"), "text")
    texts = sized_join(keyed, wanted.select("k").distinct(), ["k"], spread="text", how="left_semi")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in shingle_sets(batch.column(0), s.shingle_words):
                digests = [_digest(x) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d[0] for d in digests], pa.int64()),
                     pa.array([d[1] for d in digests], pa.int64()),
                     pa.array([x.tobytes() for x in sets], pa.binary())], ["d1", "d2", "shingles"])

    found = texts.select(F.col("text").cast("binary")).mapInArrow(
        lean(collect), "d1 long, d2 long, shingles binary")
    # texts of one class meet where they meet the cells that need it: one shuffle of the sets
    found = found.groupBy("d1", "d2").agg(F.any_value("shingles").alias("shingles"))
    return wanted.select("home", "node", "d1", "d2").join(found, ["d1", "d2"]).select(
        "home", "node", "shingles")


def near_duplicates(docs: DataFrame, settings: NearSettings | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, class_id, component_id, kept``.

    Documents are linked if their sets of word shingles have a Jaccard similarity of at least
    ``similarity_percent``.  ``class_id`` is the smallest id with the same set, ``component_id`` the
    smallest id that links reach, and a document is kept if that is its own.  A text that is null or
    has no word has an empty set and is linked with nothing.  Rows that repeat an id are each
    returned; a row without an id can be linked, and is kept only if all it is linked with lack one.
    Other columns of ``docs`` are not looked at.
    """
    s = settings or NearSettings()
    docs = whole_texts(docs).select("doc_id", "text")
    drawn = materialize(sketches(docs, s), "sketches")
    classes = drawn.filter("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(
        F.min("doc_id").alias("min_id"), F.any_value("bits").alias("bits"),
        F.any_value("keys").alias("keys"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    rows = classes.select("node", F.explode("keys").alias("key"))
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(rows.join(counts, "key"), "shared")
    weights = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    shared = shared.drop("n").join(weights, "node")
    hubs = shared.groupBy("key").agg(F.max_by("node", "weight").alias("hub"))
    buckets = materialize(shared.drop("weight").join(hubs, "key"), "buckets")

    spokes = buckets.filter("hub <> node").select(
        F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    spokes = materialize(_close(spokes, classes, s), "spokes")
    links = materialize(_confirmed(docs, classes, spokes, s), "links")
    roots = connected_components(links)

    others = materialize(_left_pairs(buckets, roots, classes, s), "others")
    if not others.isEmpty():
        more = materialize(_confirmed(docs, classes, others, s), "more")
        roots = connected_components(links.union(more))

    rooted = classes.select("node", "n_shingles", "d1", "d2", "min_id").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("min_id").alias("component_id"))
    found = rooted.join(least, "root").select(
        "n_shingles", "d1", "d2", F.col("min_id").alias("class_id"), "component_id")
    alone = F.col("n_shingles") == 0
    out = drawn.select("doc_id", "n_shingles", "d1", "d2").join(
        found, ["n_shingles", "d1", "d2"], "left")
    return out.select(
        "doc_id", "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
