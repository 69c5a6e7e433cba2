"""Record predicates as Column builders."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Predicate = Callable[[Column], Column]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def any_of(*conds: Column) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def exclusive_or(*conds: Column) -> Column:
    """True when an odd number of the conditions holds."""
    return reduce(lambda a, b: a != b, conds, F.lit(False))


def negate(cond: Column) -> Column:
    return ~cond


def matches_record(query: Mapping[str, object]) -> Column:
    """All attributes agree: a compiled pattern is searched for, a callable decides by itself,
    any other value must be equal (null only equals null)."""
    conds = []
    for name, wanted in query.items():
        if isinstance(wanted, re.Pattern):
            flag = "(?i)" if wanted.flags & re.IGNORECASE else ""
            conds.append(F.coalesce(F.col(name).cast("string").rlike(flag + wanted.pattern),
                                    F.lit(False)))
        elif callable(wanted):
            conds.append(F.coalesce(wanted(F.col(name)), F.lit(False)))
        else:
            conds.append(F.col(name).eqNullSafe(F.lit(wanted)))
    return all_of(*conds)


def wildcard_regex(pattern: str, ignore_case: bool = False) -> str:
    """``*`` any run, ``?`` one character, ``\\`` takes the next character literally.

    Anchored at line starts and ends, so one matching line of a text is enough.
    """
    out, at = [], 0
    while at < len(pattern):
        char = pattern[at]
        if char == "\\" and at + 1 < len(pattern):
            at += 1
            out.append(re.escape(pattern[at]))
        elif char in "*?":
            out.append(".*" if char == "*" else ".")
        else:
            out.append(re.escape(char))
        at += 1
    return ("(?mi)^" if ignore_case else "(?m)^") + "".join(out) + "$"


def wildcard(value: Column | str, pattern: str, ignore_case: bool = False) -> Column:
    return _col(value).cast("string").rlike(wildcard_regex(pattern, ignore_case))


def compare(value: Column | str, op: str, wanted: object, multi: bool = False,
            ignore_case: bool = False) -> Column:
    """``:`` (equal, with wildcards in strings), ``<``, ``<=``, ``>``, ``>=``.

    With ``multi`` the attribute is an array and one element that compares is enough.
    """
    def one(item: Column) -> Column:
        if op == ":":
            if isinstance(wanted, str):
                return wildcard(item, wanted, ignore_case)
            return item == F.lit(wanted)
        if op == "<":
            return item < F.lit(wanted)
        if op == "<=":
            return item <= F.lit(wanted)
        if op == ">":
            return item > F.lit(wanted)
        if op == ">=":
            return item >= F.lit(wanted)
        raise ValueError(f"unknown comparison {op}")

    return F.exists(_col(value), one) if multi else one(_col(value))


# --- typed filter conditions: strings compare without case, dates by day, times by second --------

def typed(value: Column | str, kind: str) -> Column:
    value = _col(value)
    if kind == "string":
        return F.lower(F.coalesce(value.cast("string"), F.lit("")))
    if kind == "number":
        return value.cast("double")
    if kind == "date":
        return F.to_date(value)
    if kind == "time":
        return F.substring(value.cast("string"), 12, 8)
    if kind == "boolean":
        return value.cast("boolean")
    raise ValueError(f"unknown operand type {kind}")


def _operand(wanted: object, kind: str) -> Column:
    if isinstance(wanted, Column):
        return typed(wanted, kind)
    if kind == "string":
        return F.lit(str(wanted).lower())
    if kind == "date":
        return F.to_date(F.lit(wanted))
    return F.lit(wanted)


def condition(name: str, value: Column | str, wanted: object = None,
              kind: str = "string") -> Column:
    """equal, less, less_equal, larger, larger_equal, contains, starts_with, ends_with, matches
    or empty; a missing value satisfies only ``empty``."""
    if name == "empty":
        return F.coalesce(_col(value).cast("string"), F.lit("")) == ""
    if name == "matches":
        return F.coalesce(_col(value).cast("string").rlike(str(wanted)), F.lit(False))
    left, right = typed(value, kind), _operand(wanted, kind)
    made = {
        "equal": lambda: left == right,
        "less": lambda: left < right,
        "less_equal": lambda: left <= right,
        "larger": lambda: left > right,
        "larger_equal": lambda: left >= right,
        "contains": lambda: left.contains(right),
        "starts_with": lambda: left.startswith(right),
        "ends_with": lambda: left.endswith(right),
    }
    if name not in made:
        raise ValueError(f"unknown condition {name}")
    return F.coalesce(made[name](), F.lit(False))


def any_column(df: DataFrame, pattern: str, ignore_case: bool = False) -> Column:
    """Some column, read as text, contains the pattern."""
    regex = ("(?i)" if ignore_case else "") + pattern
    texts = [f.name for f in df.schema.fields
             if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    return any_of(*[F.coalesce(F.col(f"`{c}`").cast("string").rlike(regex), F.lit(False))
                    for c in texts])
