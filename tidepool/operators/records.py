"""Filter, sort and page record tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.predicates import matches_record
from tidepool.operators.ordered import row_numbers

Where = Column | str | Mapping[str, object] | Callable[[DataFrame], Column] | None
DEEP_PAGE = 100_000  # rows before the end of a page that are still gathered as a top-k


def sort_key(name: str, descending: bool = False,
             ranks: Mapping[object, int] | None = None) -> Column:
    """Sort expression with null as the largest value; ``ranks`` gives values an order of their own
    (values without a rank follow the ranked ones)."""
    value = F.col(name)
    if ranks:
        pairs = [F.lit(x) for pair in ranks.items() for x in pair]
        value = F.when(value.isNotNull(), F.coalesce(
            F.try_element_at(F.create_map(*pairs), value), F.lit(len(ranks) + 1)))
    return value.desc_nulls_first() if descending else value.asc_nulls_last()


def multi_key_sort(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    return df.orderBy(*keys)


def where(df: DataFrame, query: Where, named: Mapping[str, Callable] | None = None) -> DataFrame:
    """Filter by a record pattern, a condition, a function of the table or the name of one."""
    if query is None:
        return df
    if isinstance(query, str):
        if not named or query not in named:
            raise KeyError(f"no filter named {query}")
        query = named[query]
    if isinstance(query, Mapping):
        return df.filter(matches_record(query))
    return df.filter(query(df) if callable(query) else query)


def page_with_total(df: DataFrame, keys: Sequence[Column], start: int = 0,
                    count: int | None = None, deep: int = DEEP_PAGE) -> DataFrame:
    """Rows ``start``..``start + count`` in the order of ``keys`` plus ``total``, the rows before
    paging.  ``keys`` must end in a unique column.

    Near pages are a top-k; those that end beyond row ``deep``, and those without a ``count``, are
    cut out by row position, which ranks the table in parallel instead of gathering ``start + count``
    rows in one place, and then sorted.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    if count is not None and start + count <= deep:
        page = df.orderBy(*keys).offset(start).limit(count)
    else:
        placed = row_numbers(df, keys, "_pos").filter(F.col("_pos") >= start)
        if count is not None:
            placed = placed.filter(F.col("_pos") < start + count)
        page = placed.orderBy("_pos").drop("_pos")
    return page.withColumn("total", total)


def top_k(df: DataFrame, keys: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*keys).limit(k)


def record_query(df: DataFrame, query: Where = None, sort: Sequence[Column] = (), start: int = 0,
                 count: int | None = None, named: Mapping[str, Callable] | None = None) -> DataFrame:
    """Filter, then sort, then page."""
    rows = where(df, query, named)
    if start or count is not None:
        return page_with_total(rows, sort, start, count)
    return multi_key_sort(rows, sort) if sort else rows
