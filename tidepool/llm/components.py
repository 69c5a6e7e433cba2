"""Connected components of a table of links, by contraction in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.storage import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root``: equal roots for nodes that ``links`` (columns ``a``, ``b``, longs) connect.

    In each round every node points to the neighbour, or itself, that comes first in an order drawn
    anew from hashes, and links are redrawn between the nodes pointed to.  A constant share of the
    nodes goes each time whatever the shape of the graph, so rounds grow with its logarithm.
    Neighbours are reduced before the shuffle, so a node may have any number of them.  Links of a
    node to itself and links with a null end connect nothing; nodes without links are not returned.
    """
    edges = materialize(links.select("a", "b").filter("a <> b"), "edges")
    roots, turn = None, 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        ends = both.union(both.select("a", F.col("a").alias("b")))
        first = ends.groupBy(F.col("a").alias("node")).agg(
            F.min_by("b", F.xxhash64("b", F.lit(turn))).alias("to"))
        first = materialize(first, "pointers")
        ends_of = lambda c: first.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}"))
        moved = edges.join(ends_of("a"), "a").join(ends_of("b"), "b").select(
            F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        edges = materialize(moved.filter("a <> b").distinct(), "edges")
        if roots is None:
            roots = first.withColumnRenamed("to", "root")
        else:
            step = first.select(F.col("node").alias("root"), "to")
            roots = roots.join(step, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root"))
            roots = materialize(roots, "roots")
        turn += 1
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return roots
