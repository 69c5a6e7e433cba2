"""Set operations on tables and on array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b.select(a.columns))


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b.select(a.columns))


def is_subset(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``is_subset``: every row of ``a`` is in ``b``."""
    same = [a[c].eqNullSafe(b[c]) for c in a.columns]
    outside = a.join(b, same, "left_anti").limit(1)  # one row outside settles it
    return outside.agg((F.count(F.lit(1)) == 0).alias("is_subset"))


def is_superset(a: DataFrame, b: DataFrame) -> DataFrame:
    return is_subset(b, a)


def array_subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0
