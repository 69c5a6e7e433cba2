"""Array functions: map, filter, fold, zip, sort, slice and set operations within a row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Fn = Callable[[Column], Column]


def distinct_filter(items: Column, keep: Fn) -> Column:
    """Elements that pass, each distinct value at its first occurrence."""
    return F.array_distinct(F.filter(items, keep))


def fold_left(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(items, start, step)


def fold_right(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    return F.aggregate(F.reverse(items), start, step)


def scan_left(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """All intermediate results of a left fold, the start value first."""
    return F.aggregate(items, F.array(start),
                       lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x)))


def scan_right(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    return F.reverse(scan_left(F.reverse(items), start, step))


def zip_shortest(*arrays: Column) -> Column:
    """Array of structs, as long as the shortest input."""
    shortest = F.least(*[F.size(a) for a in arrays]) if len(arrays) > 1 else F.size(arrays[0])
    return F.arrays_zip(*[F.slice(a, F.lit(1), shortest).alias(f"a{i}")
                          for i, a in enumerate(arrays)])


def field_of(name: str) -> Fn:
    return lambda item: item[name]


def unzip(pairs: Column, fields: Sequence[str]) -> list[Column]:
    return [F.transform(pairs, field_of(f)) for f in fields]


def sort_by(items: Column, keys: Sequence[tuple[Fn, bool]]) -> Column:
    """Sort by several keys, each ``(key, descending)``; a null key is larger than any value."""
    def order(left: Column, right: Column) -> Column:
        out = F.lit(0)
        for key, descending in reversed(keys):
            up, down = (-1, 1) if descending else (1, -1)
            a, b = key(left), key(right)
            out = (F.when(a.eqNullSafe(b), out)
                   .when(a.isNull(), F.lit(up)).when(b.isNull(), F.lit(down))
                   .when(a > b, F.lit(up)).otherwise(F.lit(down)))
        return out

    return F.array_sort(items, order)


def slice_step(items: Column, start: int = 0, end: int = 0, step: int = 1) -> Column:
    """``[start:end:step]``: negative bounds count from the end, an ``end`` of 0 is the length."""
    if step < 1:
        raise ValueError("step must be positive")
    size = F.size(items)
    low = F.greatest(F.lit(0), F.lit(start) + size) if start < 0 else F.least(size, F.lit(start))
    if end == 0:
        high = size
    else:
        high = F.greatest(F.lit(0), F.lit(end) + size) if end < 0 else F.least(size, F.lit(end))
    return F.filter(items, lambda _, i: (i >= low) & (i < high) & ((i - low) % step == 0))


def pick_many(items: Column, picks: Sequence[int]) -> Column:
    """The elements at the given 0-based places, null where there is none."""
    return F.array(*[F.get(items, F.lit(p)) for p in picks])
