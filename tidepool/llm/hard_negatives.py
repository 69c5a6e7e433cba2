"""Hard-negative mining with an inverted multi-index and certified stopping.

Vectors are cut into two halves, and each half-space has a codebook.  A pair of codewords is a cell of
the index.  For an anchor, a half's score with any vector of a cell is at most its score with the
codeword plus its length times the cell's radius.  A heap walks the cells by the sum of both bounds,
largest first, and stops as soon as what it has is certified: no cell that is left can hold a vector
that would change the result.  So the results are those of a full search.

Blocks of the index, each with all its cells and radii of its own, meet blocks of anchors; a block's
best rows are certified within it and merged between blocks.  Blocks are dealt by hash, so neither a
frequent label nor a frequent vector fills one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.storage import materialize

_EXACT = 1 << 53


@dataclass(frozen=True)
class MiningSettings:
    """``sample`` bounds the vectors that the codebooks are learned from; every row is indexed."""

    positives: int = 5
    negatives: int = 5
    low_percent: int = 80         # of the positive's score that a negative has at least
    high_percent: int = 100       # and at most
    scale: int = 256
    sample: int = 4096
    iterations: int = 8           # of the codebooks' refinement
    rows_per_cell: int = 16       # that a block has on average
    codewords: int = 32           # of a half at most
    least_block: int = 4096       # vectors of a block of the index
    most_block: int = 1 << 16
    anchors: int = 4096           # that meet such a block at once
    batch: int = 1024             # vectors of the next cells that are scored together


def usable(rows: DataFrame) -> DataFrame:
    """``id, h, label, v, anchor``: the rows that take part, equal rows once.

    ``h`` tells rows of one id apart.
    """
    v = F.col("embedding")
    fine = v.isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(fine).select(
        F.col("vec_id").cast("long").alias("id"), F.xxhash64("label", "embedding").alias("h"),
        F.col("label").cast("long").alias("label"), v.cast("array<double>").alias("v"),
        F.coalesce("anchor", F.lit(False)).alias("anchor"))
    return rows.dropDuplicates(["id", "h"])


def whole_vectors(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, shorter vectors filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy()
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = np.floor(scale * column.flatten().to_numpy())
    return out


def _scores(rows: np.ndarray, anchor: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of whole vectors with components up to ``most``, in floating point where
    nothing can be rounded."""
    if most * max(np.abs(anchor).max(initial=0), 1) * max(rows.shape[1], 1) < _EXACT:
        return (rows @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    return np.array([sum(int(x) * y for x, y in zip(row, whole)) for row in rows], np.int64)


def learned_codebook(points: np.ndarray, k: int, iterations: int) -> np.ndarray:
    """Codewords of a sample, the first ones spread evenly over it."""
    words = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(iterations):
        of = nearest_codeword(points, words)
        for w in range(k):
            own = points[of == w]
            if len(own):
                words[w] = own.mean(0)
    return words


def nearest_codeword(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.argmin((words * words).sum(1) - 2 * points @ words.T, axis=1)


class Cells:
    """A block of the index: rows by cell, with the radius of every codeword among them."""

    def __init__(self, x: np.ndarray, books: tuple[np.ndarray, np.ndarray]):
        self.cut = books[0].shape[1]
        self.books = books
        self.most = max(np.abs(x).max(initial=0), 1)
        halves = (x[:, :self.cut], x[:, self.cut:])
        of = [nearest_codeword(h, b) for h, b in zip(halves, books)]
        self.radii = []
        for h, b, w in zip(halves, books, of):
            apart = np.sqrt(((h - b[w]) ** 2).sum(1))
            radius = np.zeros(len(b))
            np.maximum.at(radius, w, apart)
            self.radii.append(radius * (1 + 1e-9) + 1e-9)
        cell = of[0] * len(books[1]) + of[1]
        self.order = np.argsort(cell, kind="stable")
        self.begins = np.searchsorted(cell[self.order], np.arange(len(books[0]) * len(books[1]) + 1))

    def visits(self, anchor: np.ndarray, batch: int) -> Iterator[tuple[np.ndarray, float]]:
        """(rows, bound): the rows of the next cells, and what no row after them exceeds."""
        bounds, ranks = [], []
        for half, book, radius in zip((anchor[:self.cut], anchor[self.cut:]), self.books, self.radii):
            length = np.sqrt((half * half).sum())
            bound = book @ half + length * radius
            bound = bound + np.abs(bound) * 1e-9 + 1e-6  # never below the true one by rounding
            order = np.argsort(-bound)
            bounds.append(bound[order].tolist())
            ranks.append(order.tolist())
        (up, side), (rows, columns) = bounds, ranks
        heap, held, size, wide = [(-(up[0] + side[0]), 0, 0)], [], 0, len(columns)
        while heap:
            _, i, j = heapq.heappop(heap)
            if j + 1 < wide:
                heapq.heappush(heap, (-(up[i] + side[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(rows):
                heapq.heappush(heap, (-(up[i + 1] + side[0]), i + 1, 0))
            cell = rows[i] * wide + columns[j]
            a, b = self.begins[cell], self.begins[cell + 1]
            if a < b:
                held.append(self.order[a:b])
                size += b - a
            if size >= batch or not heap:
                left = -heap[0][0] if heap else -np.inf
                yield np.concatenate(held) if held else np.zeros(0, np.int64), left
                held, size = [], 0


def _best(score: np.ndarray, key: np.ndarray, h: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, ties by id and hash."""
    if len(score) > most:
        least = np.partition(score, len(score) - most)[len(score) - most]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    order = np.lexsort((h[rows[some]], key[rows[some]], -score[some]))
    return some[order[:most]]


class _Top:
    """The best rows so far whose scores lie in a window, and whether more can be found."""

    def __init__(self, low, high, most: int):
        self.low, self.high, self.most = low, high, most
        self.rows, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, rows, score, key, h) -> None:
        some = (score >= self.low) & (score <= self.high)
        if len(self.rows) == self.most:
            some &= score >= self.score[-1]
        if some.any():
            rows, score = np.append(self.rows, rows[some]), np.append(self.score, score[some])
            best = _best(score, key, h, rows, self.most)
            self.rows, self.score = rows[best], score[best]

    def certified(self, bound: float) -> bool:
        return bound < self.low or len(self.rows) == self.most and bound < self.score[-1]


def _search(cells: Cells, x, key, h, label, anchor, own_id, own_label, tops, same: bool, batch: int):
    """Fill ``tops`` from the rows of the anchor's label, or of the others, until all are certified."""
    for rows, bound in cells.visits(anchor, batch):
        rows = rows[label[rows] == own_label] if same else rows[label[rows] != own_label]
        rows = rows[key[rows] != own_id]
        if len(rows):
            score = _scores(x[rows], anchor, cells.most)
            for top in tops:
                top.add(rows, score, key, h)
        if all(top.certified(bound) for top in tops):
            return


def _grid(rows: DataFrame, anchors: DataFrame, blocks: int, parts: int) -> tuple[DataFrame, DataFrame]:
    """Rows by block, repeated for each part of the anchors, and anchors the other way round."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "h"), F.lit(blocks)).cast("int"))
    anchors = anchors.withColumn("part", F.pmod(F.xxhash64("id", "h"), F.lit(parts)).cast("int"))
    return rows.withColumn("part", numbers(parts)), anchors.withColumn("block", numbers(blocks))


def mine_hard_negatives(rows: DataFrame, is_anchor: Column, relabel: Column | None = None,
                        settings: MiningSettings | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id``, ``embedding`` and ``label``; ``is_anchor`` is a condition on ``vec_id``
    and ``relabel`` a label in place of the row's own.  Components become floor(scale * x), scores are
    whole inner products (shorter vectors count as filled up with zeros), higher ones come first and
    ties by smaller id.  An anchor's positives are its first ``positives`` other rows of its label;
    for each, the first ``negatives`` rows of other labels are returned whose score is between
    ``low_percent`` and ``high_percent`` of the positive's.

    Rows with a null label, vector or id, or a null or non-finite component, take no part.  Equal rows
    count once; rows that share an id with the anchor are not others, and different anchors under one
    id each have results.  A score that does not fit a long is an error.  Other columns are not looked
    at; an empty table gives no rows.
    """
    s = settings or MiningSettings()
    label = F.col("label") if relabel is None else relabel
    held = usable(rows.select("vec_id", "embedding", label.alias("label"), is_anchor.alias("anchor")))
    held = materialize(held, "vectors")
    shape = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    n, width = shape["n"], shape["width"] or 0
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    size = max(s.least_block, min(s.most_block, n // 64))
    sample = held.orderBy(F.xxhash64("id", F.lit("sample")), "id", "h").limit(s.sample)
    points = whole_vectors(sample.select("v").toArrow()["v"], width, s.scale)  # a bounded sample
    k = max(1, min(s.codewords, int(np.sqrt(min(n, size) / s.rows_per_cell)), len(points)))
    books = tuple(learned_codebook(points[:, a:b], k, s.iterations)
                  for a, b in ((0, width // 2), (width // 2, width)))

    anchors = materialize(held.filter("anchor").drop("anchor"), "anchors")
    blocks = -(-n // size)
    parts = -(-max(1, anchors.count()) // s.anchors)

    def block_of(table: pa.Table):
        x = whole_vectors(table["v"], width, s.scale)
        return x, *(table[c].to_numpy() for c in ("id", "h", "label"))

    def positives(_, own: pa.Table, some: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if own.num_rows and some.num_rows:
            x, key, h, label = block_of(own)
            cells = Cells(x, books)
            for anchor, a, ah, al in zip(*block_of(some)):
                top = _Top(-np.inf, np.inf, s.positives)
                _search(cells, x, key, h, label, anchor, a, al, [top], True, s.batch)
                out += [(a, ah, key[r], h[r], int(p)) for r, p in zip(top.rows, top.score)]
        return _table(out, ["id", "h", "pos", "pos_h", "score"])

    def negatives(_, own: pa.Table, some: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if own.num_rows and some.num_rows:
            x, key, h, label = block_of(own)
            cells = Cells(x, books)
            for anchor, a, ah, al, found in zip(*block_of(some), some["positives"].to_pylist()):
                tops = [_Top(-(-s.low_percent * p["score"] // 100), s.high_percent * p["score"] // 100,
                             s.negatives) for p in found]
                open_ones = [t for t in tops if t.low <= t.high]
                if open_ones:
                    _search(cells, x, key, h, label, anchor, a, al, open_ones, False, s.batch)
                for place, top in enumerate(tops):
                    out += [(a, ah, place, key[r], h[r], int(q)) for r, q in zip(top.rows, top.score)]
        return _table(out, ["id", "h", "place", "neg", "neg_h", "score"])

    def met(some: DataFrame, search, kind: str) -> DataFrame:
        left, right = _grid(held.drop("anchor"), some, blocks, parts)
        return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(
            search, kind)

    first = Window.partitionBy("id", "h").orderBy(F.desc("score"), "pos", "pos_h")
    found = met(anchors, positives, "id long, h long, pos long, pos_h long, score long")
    found = found.withColumn("place", F.row_number().over(first) - 1).filter(
        F.col("place") < s.positives)
    found = materialize(found, "positives")
    lists = found.groupBy("id", "h").agg(F.sort_array(F.collect_list(F.struct(
        "place", "score"))).alias("positives"))
    best = Window.partitionBy("id", "h", "place").orderBy(F.desc("negative_score"), "neg", "neg_h")
    mined = met(anchors.join(lists, ["id", "h"]), negatives,
                "id long, h long, place long, neg long, neg_h long, score long")
    mined = mined.withColumnRenamed("score", "negative_score").withColumn(
        "rank", F.row_number().over(best)).filter(F.col("rank") <= s.negatives)
    out = mined.join(found.withColumn("place", F.col("place").cast("long")), ["id", "h", "place"])
    return out.select(F.col("id").alias("anchor_id"), F.col("pos").alias("positive_id"), "rank",
                      F.col("neg").alias("negative_id"), F.col("score").alias("positive_score"),
                      "negative_score")


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table({name: pa.array([int(v) for v in c], pa.int64()) for name, c in zip(names, columns)})
