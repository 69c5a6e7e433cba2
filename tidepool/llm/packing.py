"""Packing by non-negative least squares.

Document lengths are counted in units.  Shallow combinations of lengths that fill a window exactly
are enumerated, and how often each is used is solved as a non-negative least-squares problem against
the histogram, then rounded down.  Documents take their places by rank within their length, so no
task sees more than its own rows.  Residual documents are packed greedily: laid end to end and cut,
they fill what rounding up to units left open and then windows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.batches import lean, release_memory, whole_texts
from tidepool.llm.tokens import END_ID, crc32, default_tokenizer, encoded_texts
from tidepool.storage import materialize, sized_join

ROWS = 65_536  # rows of a block of a running total


@dataclass(frozen=True)
class PackSettings:
    window: int = 4096
    unit: int = 64       # lengths are rounded up to units for the combinations
    depth: int = 6       # documents in a combination at most
    cache_words: int | None = None  # that a worker remembers twice at most; None: as many as elsewhere

    @property
    def units(self) -> int:
        return self.window // self.unit


def combinations(units: int, depth: int) -> np.ndarray:
    """One row per multiset of at most ``depth`` lengths that add up to ``units``: their counts."""
    found: list[list[int]] = []

    def extend(parts, left, largest):
        if left == 0:
            found.append(parts)
        elif len(parts) < depth:
            smallest = -(-left // (depth - len(parts)))
            for part in range(min(left, largest), smallest - 1, -1):
                extend([*parts, part], left - part, part)

    extend([], units, units)
    out = np.zeros((len(found), units + 1), np.int32)
    for row, parts in enumerate(found):
        np.add.at(out[row], parts, 1)
    return out


def non_negative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min |a x - b| with x >= 0, by the active-set method of Lawson and Hanson."""
    x = np.zeros(a.shape[1])
    free = np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(6 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[free] = -np.inf
        best = int(gradient.argmax())
        if gradient[best] <= tolerance:
            break
        free[best] = True
        while True:
            columns = np.flatnonzero(free)
            z = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[columns] = z
                break
            low = z <= 0
            step = x[columns][low] / np.maximum(x[columns][low] - z[low], 1e-300)
            x[columns] += step.min() * (z - x[columns])
            free[columns[x[columns] <= 1e-12 * max(1.0, x.max())]] = False
            x[~free] = 0
            if not free.any():
                break
    return x


def solve_repeats(histogram: dict[int, int], tokens: int, s: PackSettings
                  ) -> list[tuple[np.ndarray, int]]:
    """(combination, repeats), never more of a length than there is, nor more windows than tokens fill."""
    supply = np.zeros(s.units + 1)
    for units, n in histogram.items():
        supply[units] = n
    if not supply.any():
        return []
    combos = combinations(s.units, s.depth)
    weight = np.arange(s.units + 1, dtype=float)  # a long document left over costs more
    x = non_negative_least_squares((combos * weight).T.astype(float), supply * weight)
    repeats = np.floor(x + 1e-6).astype(np.int64)
    for units in range(1, s.units + 1):
        over = int(combos[:, units] @ repeats - supply[units])
        for c in np.argsort(-repeats, kind="stable"):
            if over <= 0:
                break
            if combos[c, units] and repeats[c]:
                drop = min(repeats[c], -(-over // int(combos[c, units])))
                repeats[c] -= drop
                over -= int(drop * combos[c, units])
    spare = int(repeats.sum()) - tokens // s.window
    for c in np.argsort(repeats, kind="stable"):
        if spare <= 0:
            break
        drop = min(int(repeats[c]), spare)
        repeats[c] -= drop
        spare -= drop
    return [(combos[c], int(repeats[c])) for c in np.flatnonzero(repeats)]


def encode_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int | None,
                  cache_words: int | None = None) -> DataFrame:
    """``doc_id, n, tail, tail_crc, full_crcs, ids``: the checksums of full windows and of the rest."""
    schema = "doc_id long, n long, tail int, tail_crc long, full_crcs array<bigint>, ids binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, first, held, size = batch.column(0), 0, [], 0
            for i, ids in enumerate(encoded_texts(batch.column(1), tokenizer, end_id, cache_words)):
                held.append(ids)
                size += len(ids)
                if size >= 1 << 22 or i + 1 == len(keys):
                    n = [len(x) // 4 for x in held]
                    tails = [x % window for x in n]
                    crcs = [crc32(x[4 * (a - t):]) for x, a, t in zip(held, n, tails)]
                    full = [[crc32(x[4 * k:4 * (k + window)])
                             for k in range(0, a - window + 1, window)] for x, a in zip(held, n)]
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(first, len(held)), pa.array(n, pa.int64()),
                         pa.array(tails, pa.int32()), pa.array(crcs, pa.int64()),
                         pa.array(full, pa.list_(pa.int64())), pa.array(held, pa.binary())],
                        ["doc_id", "n", "tail", "tail_crc", "full_crcs", "ids"])
                    first, held, size = i + 1, [], 0
            release_memory()  # the cache of words stays, and grows; the batch must not

    return whole_texts(docs).select("doc_id", F.col("text").cast("binary")).mapInArrow(lean(encode, keep=True), schema)


def running_start(df: DataFrame, index: str, value: str, out: str) -> DataFrame:
    """The sum of ``value`` over all rows with a smaller ``index`` (a unique long), in blocks."""
    blocked = df.withColumn("_block", F.floor(F.col(index) / ROWS))
    totals = blocked.groupBy("_block").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_at"))
    within = Window.partitionBy("_block").orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    return blocked.join(totals, "_block").withColumn(
        out, F.col("_at") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_block", "_at")


def ranked(df: DataFrame, group: str, key: str, out: str, chunks: int) -> DataFrame:
    """Number the rows of each group from 0, whatever share of all rows it has."""
    parted = df.withColumn("_chunk", F.pmod(F.xxhash64(key), F.lit(chunks)))
    sizes = parted.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(group, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    within = Window.partitionBy(group, "_chunk").orderBy(key)
    return parted.join(sizes, [group, "_chunk"]).withColumn(
        out, F.col("_at") + F.row_number().over(within) - 1).drop("_chunk", "_at")


def _driver_rows(spark: SparkSession, rows: list[tuple], *names: str) -> DataFrame:
    """A table of whole numbers that the driver computed.

    It comes from Arrow: rows given as a list pass through Python on the executors, in workers of
    another kind than those of Arrow functions, which stay in memory beside them.
    """
    columns = list(zip(*rows)) or [()] * len(names)
    return spark.createDataFrame(pa.table(
        [pa.array([int(x) for x in c], pa.int64()) for c in columns], names=list(names)))


def pack_documents(docs: DataFrame, tokenizer: str | None = None,
                   settings: PackSettings | None = None, end_id: int | None = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A null text counts as empty and has only its end id (without one it has no piece).  Rows that
    repeat an id are packed each.  Only documents longer than a window and residual documents are
    cut; a last window that is not full is split into powers of two, which need no padding.  Other
    columns of ``docs`` are not looked at.
    """
    s = settings or PackSettings()
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    encoded = encode_pieces(docs.select("doc_id", "text"), path, s.window, end_id, s.cache_words)
    encoded = materialize(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")
    piece = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    tails = encoded.filter("tail > 0").select(
        "row", "doc_id", F.col("n").alias("doc_tokens"), F.col("tail").cast("long").alias("length"),
        F.col("tail_crc").alias("ids_crc32"), (F.col("n") - F.col("tail")).alias("start"),
        F.ceil(F.col("tail") / s.unit).cast("int").alias("units"))
    counted = tails.groupBy("units").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("t"))
    bins = counted.collect()  # one row per length in units
    supply = {r["units"]: r["n"] for r in bins}
    tokens = sum(r["t"] for r in bins)
    solution = solve_repeats(supply, tokens, s)
    windows = sum(repeats for _, repeats in solution)

    slots, used, base = [], dict.fromkeys(supply, 0), 0
    for combo, repeats in solution:
        place = 0
        for units in np.flatnonzero(combo):
            units, times = int(units), int(combo[units])
            first = used[units]
            used[units] += times * repeats
            slots.append((units, first, used[units], times, base, place))
            place += times
        base += repeats
    slots = _driver_rows(spark, slots, "units", "lo", "hi", "times", "base", "place")
    rests = _driver_rows(spark, list(used.items()), "units", "used")

    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 sum(supply.values()) // 100_000 + 1)
    ranks = materialize(ranked(tails, "units", "row", "rank", chunks), "ranks")
    seated = ranks.join(F.broadcast(slots), "units").filter("rank >= lo and rank < hi").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("base") + F.expr("(rank - lo) div times")).alias("sequence_id"),
        (F.col("place") + F.expr("(rank - lo) % times")).alias("slot"))
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1)
    seated = materialize(seated.withColumn(
        "offset", F.coalesce(F.sum("length").over(before), F.lit(0))), "seated")

    filled = seated.groupBy("sequence_id").agg(F.sum("length").alias("offset"))
    gaps = filled.select("sequence_id", "offset", (s.window - F.col("offset")).alias("gap"))
    taken = seated.agg(F.sum("length").alias("t")).first()["t"] or 0
    left = tokens - taken - (windows * s.window - taken)  # tokens beyond the gaps
    more, last = divmod(left, s.window)
    ends = [1 << k for k in reversed(range(last.bit_length())) if last >> k & 1]
    own = spark.range(more).select(
        (F.col("id") + windows).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.lit(s.window).cast("long").alias("gap"))
    tail_windows = _driver_rows(
        spark, [(windows + more + i, 0, size) for i, size in enumerate(ends)],
        "sequence_id", "offset", "gap")
    gaps = running_start(gaps.filter("gap > 0").unionByName(own).unionByName(tail_windows),
                         "sequence_id", "gap", "from")
    windows += more + len(ends)

    over = Window.orderBy(F.desc("units")).rowsBetween(Window.unboundedPreceding, -1)
    order = rests.withColumn("left", F.lit(0).cast("long")).select("units", "used")
    order = order.join(counted.select("units", "n"), "units").select(
        "units", "used", F.coalesce(F.sum(F.col("n") - F.col("used")).over(over), F.lit(0))
        .alias("first"))
    residual = ranks.join(F.broadcast(order), "units").filter("rank >= used").withColumn(
        "index", F.col("rank") - F.col("used") + F.col("first"))
    residual = running_start(residual, "index", "length", "from")
    cut = materialize(_overlaps(residual, gaps, s.window), "cut")
    whole = cut.filter("length = whole")
    parts = _checksums(cut.filter("length < whole"), encoded)

    numbered = encoded.filter("size(full_crcs) > 0").withColumn(
        "times", F.size("full_crcs").cast("long"))
    numbered = ranked(numbered.withColumn("one", F.lit(1)).select(
        "row", "one", "doc_id", "n", "times", "full_crcs"), "one", "row", "rank", chunks)
    numbered = running_start(numbered, "rank", "times", "first")
    full = numbered.select(
        "doc_id", F.col("n").alias("doc_tokens"), "first",
        F.posexplode("full_crcs").alias("k", "ids_crc32")).select(
        "doc_id", (F.col("k") * F.lit(s.window)).cast("long").alias("start"),
        F.lit(s.window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.col("first") + F.col("k") + windows).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    out = seated.select(*piece)
    for more_pieces in (whole, parts, full):
        out = out.unionByName(more_pieces.select(*piece))
    return out


def _overlaps(residual: DataFrame, gaps: DataFrame, cell: int) -> DataFrame:
    """Where the residual documents, end to end, meet the gaps, end to end: one row per piece.

    Neither a document nor a gap is longer than a cell, so each lies in two cells at most, and a
    piece is reported in the cell in which it begins.
    """
    def celled(df, size):
        last = F.col("from") + F.col(size) - 1
        return df.withColumn("cell", F.explode(F.sequence(
            F.floor(F.col("from") / cell), F.floor(last / cell))))

    d = celled(residual, "length").select(
        "cell", "row", "doc_id", "doc_tokens", "ids_crc32", "start",
        F.col("length").alias("whole"), F.col("from").alias("d0"))
    g = celled(gaps, "gap").select(
        "cell", "sequence_id", "offset", F.col("from").alias("g0"),
        (F.col("from") + F.col("gap")).alias("g1"))
    first = F.greatest("d0", "g0")
    met = d.join(g, "cell").withColumn("p0", first).withColumn(
        "p1", F.least(F.col("d0") + F.col("whole"), F.col("g1")))
    met = met.filter((F.col("p0") < F.col("p1")) & (F.floor(F.col("p0") / cell) == F.col("cell")))
    return met.select(
        "row", "doc_id", "doc_tokens", "ids_crc32", "whole", "sequence_id",
        (F.col("start") + F.col("p0") - F.col("d0")).alias("start"),
        (F.col("p1") - F.col("p0")).alias("length"),
        (F.col("offset") + F.col("p0") - F.col("g0")).alias("offset"))


def _checksums(parts: DataFrame, encoded: DataFrame) -> DataFrame:
    """Checksums of pieces of cut documents, from their stored ids."""
    cuts = parts.groupBy("row").agg(F.collect_list(F.struct(
        "doc_id", "doc_tokens", "start", "length", "sequence_id", "offset")).alias("cuts"))
    rows = sized_join(encoded.select("row", "ids"), cuts, ["row"], spread="ids")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids, cuts in zip(batch.column(0), batch.column(1)):
                raw = ids.as_py()
                for cut in cuts.as_py():
                    a = cut["start"]
                    out.append(cut | {"ids_crc32": crc32(raw[4 * a:4 * (a + cut["length"])])})
            yield pa.RecordBatch.from_pylist(out, schema=wanted)

    wanted = pa.schema([(c, pa.int64()) for c in (
        "doc_id", "doc_tokens", "start", "length", "sequence_id", "offset", "ids_crc32")])
    return rows.select("ids", "cuts").mapInArrow(
        lean(check), ", ".join(f"`{f.name}` long" for f in wanted))
