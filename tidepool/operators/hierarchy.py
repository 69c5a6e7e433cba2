"""Parent and child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.storage import materialize, sized_join


def tree_flatten(edges: DataFrame, roots: DataFrame, separator: str = "/") -> DataFrame:
    """(node, depth, path) from edges (parent, child) and roots (node), by doubling.

    A round knows, for every node, the ways up that have a fixed length, 1, 2, 4 and so on, and all
    shorter ones from a root.  Putting the former on top of each other doubles the length, putting them
    on top of the latter gives the paths that end within it, so there are as many rounds as the
    logarithm of the depth, whatever the depth is.  A node with several parents has a row for each
    path.  A parent with a large share of all children is spread by child.  A node below itself
    raises, whether or not a root leads to it.
    """
    text = lambda c: F.array(F.col(c).cast("string"))
    done = materialize(roots.select("node", text("node").alias("path")), "done")
    ways = edges.select(F.col("child").alias("node"), F.col("parent").alias("above"),
                        text("child").alias("path")).filter("above IS NOT NULL AND node IS NOT NULL")
    ways = materialize(_checked(ways, F.concat(text("above"), "path")), "ways1")
    length = 1
    while True:
        if not ways.filter("again").isEmpty():
            raise ValueError("the edges hold a cycle")
        if ways.isEmpty():
            break
        lower = ways.select("node", F.col("above").alias("_at"), F.col("path").alias("_tail"))
        ended = sized_join(lower, done.withColumnRenamed("node", "_at"), ["_at"], spread="node")
        ended = materialize(ended.select("node", F.concat("path", "_tail").alias("path")), "done")
        upper = ways.select(F.col("node").alias("_at"), "above", "path")
        longer = sized_join(lower, upper, ["_at"], spread="node").select(
            "node", "above", F.concat("path", "_tail").alias("path"))
        length *= 2
        ways = materialize(_checked(longer, F.concat(text("above"), "path")), f"ways{length}")
        done = done.unionByName(ended)
    return done.select("node", (F.size("path") - 1).alias("depth"),
                       F.array_join("path", separator).alias("path"))


def _checked(ways: DataFrame, nodes: Column) -> DataFrame:
    """With ``again``: whether a way meets a node twice."""
    return ways.withColumn("again", F.size(F.array_distinct(nodes)) < F.size(nodes))
