"""Overlap and example joins without a nested loop."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.storage import materialize, sized_join


def interval_overlap_join(a: DataFrame, b: DataFrame, a_span: tuple[str, str],
                          b_span: tuple[str, str], on: Sequence[str] = (),
                          include_limits: bool = False) -> DataFrame:
    """Pairs whose ranges overlap; with ``include_limits`` touching ends count.

    Spans are integers.  Ranges are put on grids of width 2^level.  A range's own level is the
    smallest whose width exceeds its length, so it covers at most two cells there and on every
    coarser grid.  A pair meets exactly once: on the coarser of its two levels, in the cell that
    holds the later of the two starts.  The join is an equi-join on (on, level, cell); crowded
    cells are split.  A null end never overlaps.
    """
    def level(span: tuple[str, str]) -> Column:
        return F.length(F.bin(F.abs(F.col(span[1]) - F.col(span[0]))))

    def known(df: DataFrame, span: tuple[str, str], side: str) -> DataFrame:
        df = df.filter(F.col(span[0]).isNotNull() & F.col(span[1]).isNotNull())
        return df.withColumn(f"_{side}_level", level(span))

    a, b = known(a, a_span, "a"), known(b, b_span, "b")
    a, b = materialize(a, "left_spans"), materialize(b, "right_spans")
    # At most 64 values a side, whatever the data.
    present = {s: sorted(r[0] for r in df.select(f"_{s}_level").distinct().collect())
               for s, df in (("a", a), ("b", b))}

    def placed(df: DataFrame, span: tuple[str, str], side: str) -> DataFrame:
        """A range lies on its own grid and on the coarser ones that the other side has."""
        own, other = present[side], present["b" if side == "a" else "a"]
        low, high = F.least(*span), F.greatest(*span)

        def on_grid(n: int) -> Column:
            cells = F.sequence(F.shiftright(low, n), F.shiftright(high, n))
            return F.transform(cells, lambda c: F.struct(F.lit(n).alias("l"), c.alias("c")))

        options = [F.when(F.col(f"_{side}_level") == n, on_grid(n)) for n in own]
        options += [F.when(F.col(f"_{side}_level") < n, on_grid(n)) for n in other]
        options = options or [F.lit(None).cast("array<struct<l:int,c:bigint>>")]
        cells = F.flatten(F.filter(F.array(*options), lambda x: x.isNotNull()))
        return df.withColumn("_cell", F.explode(cells)).select(
            *df.columns, F.col("_cell.l").alias("_level"), F.col("_cell.c").alias("_at"))

    left, right = placed(a, a_span, "a"), placed(b, b_span, "b")
    joined = sized_join(left, right, [*on, "_level", "_at"], spread=a_span[0])
    a0, a1, b0, b1 = (F.col(c) for c in (*a_span, *b_span))
    overlap = (a0 <= b1) & (b0 <= a1) if include_limits else (a0 < b1) & (b0 < a1)
    once = ((F.col("_level") == F.greatest("_a_level", "_b_level"))
            & (F.expr(f"shiftright(greatest(`{a_span[0]}`, `{b_span[0]}`), _level)")
               == F.col("_at")))
    return joined.filter(overlap & once).drop("_level", "_at", "_a_level", "_b_level")


def query_by_example_join(records: DataFrame, examples: DataFrame, attributes: Sequence[str],
                          example_id: str) -> DataFrame:
    """Records agreeing with an example on every attribute the example fixes (null = anything).

    Equal examples count once, under their smallest id.  Which attributes an example fixes is its
    kind, of which there are at most 2^attributes.  Each record is read once and offers one key for
    every kind there is, so it is one equi-join on kind and fixed values.
    """
    distinct = examples.groupBy(*attributes).agg(F.min(example_id).alias(example_id))
    mask = reduce(lambda x, y: x + y,
                  [F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
                   for i, c in enumerate(attributes)])
    distinct = distinct.withColumn("_mask", mask)
    kinds = sorted(r[0] for r in distinct.select("_mask").distinct().collect())
    spread = next((c for c in records.columns if c not in attributes), attributes[0])
    if not kinds:
        return records.withColumn(example_id, F.lit(None).cast(examples.schema[example_id].dataType)
                                  ).filter(F.lit(False))

    def key(kind: int) -> Column:
        """The fixed values by name; null for a record that lacks one of them."""
        fixed = [c for i, c in enumerate(attributes) if kind >> i & 1]
        values = F.to_json(F.struct(F.lit(kind).alias("_kind"), *fixed))
        return F.when(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in fixed], F.lit(True)),
                      values)

    offered = F.filter(F.array(*[key(kind) for kind in kinds]), lambda k: k.isNotNull())
    by_kind = reduce(lambda done, kind: done.when(F.col("_mask") == kind, key(kind)), kinds[1:],
                     F.when(F.col("_mask") == kinds[0], key(kinds[0])))
    asked = distinct.select(by_kind.alias("_key"), example_id)
    joined = sized_join(records.withColumn("_key", F.explode(offered)), asked, ["_key"], spread)
    return joined.select(*records.columns, example_id)
