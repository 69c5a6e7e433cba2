"""Data-quality reports: many rules in one pass over a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rule_report(df: DataFrame, rules: Mapping[str, Column], weight: str | None = None) -> DataFrame:
    """(rule, n, n_pass, n_fail) from a single aggregate over the table.

    ``weight`` names a column saying for how many equal rows a row stands.
    """
    count = F.lit(1).cast("long") if weight is None else F.col(weight)
    zero = F.lit(0).cast("long")
    passed = [F.coalesce(F.sum(F.when(cond, count)), zero).alias(f"_p{i}")
              for i, cond in enumerate(rules.values())]
    one = df.agg(F.coalesce(F.sum(count), zero).alias("n"), *passed)
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"_p{i}").alias("n_pass"))
                               for i, name in enumerate(rules)]))
    return one.select("n", rows.alias("_r")).select(
        F.col("_r.rule").alias("rule"), "n", F.col("_r.n_pass").alias("n_pass"),
        (F.col("n") - F.col("_r.n_pass")).alias("n_fail"))


def rule_failures(df: DataFrame, rules: Mapping[str, Column], key: str) -> DataFrame:
    """(key, rule) for every rule a row breaks."""
    broken = F.filter(F.array(*[F.when(~F.coalesce(cond, F.lit(False)), F.lit(name))
                                for name, cond in rules.items()]), lambda r: r.isNotNull())
    return df.select(key, F.explode(broken).alias("rule"))


@dataclass(frozen=True)
class Property:
    """What a column must satisfy; ``type`` is string, number, integer, boolean or any."""

    type: str = "any"
    optional: bool = False
    disallow: str | None = None
    pattern: str | None = None
    min_length: int | None = None
    max_length: int | None = None
    minimum: float | None = None
    maximum: float | None = None
    enum: tuple = ()
    max_decimal: int | None = None
    min_items: int | None = None
    max_items: int | None = None
    items: "Property | None" = field(default=None)


def _has_type(value: Column, data: T.DataType, wanted: str) -> Column:
    numeric = isinstance(data, T.NumericType)
    if wanted == "any":
        return F.lit(True)
    if wanted == "integer":
        return value % 1 == 0 if numeric else F.lit(False)
    fits = {"string": isinstance(data, T.StringType), "number": numeric,
            "boolean": isinstance(data, T.BooleanType), "array": isinstance(data, T.ArrayType),
            "object": isinstance(data, (T.StructType, T.MapType)), "null": False}
    return F.lit(fits[wanted])


def _checks(value: Column, data: T.DataType, spec: Property) -> list[tuple[Column, str]]:
    """(fails, message) pairs for a present value."""
    out = [(~_has_type(value, data, spec.type), f"not of type {spec.type}")]
    if spec.disallow:
        out.append((_has_type(value, data, spec.disallow), "of a type that is not allowed"))
    if isinstance(data, T.StringType):
        if spec.pattern is not None:
            out.append((~value.rlike(spec.pattern),
                        f"not like {spec.pattern}"))
        if spec.max_length is not None:
            out.append((F.length(value) > spec.max_length,
                        f"longer than {spec.max_length}"))
        if spec.min_length is not None:
            out.append((F.length(value) < spec.min_length,
                        f"shorter than {spec.min_length}"))
    if isinstance(data, T.NumericType):
        if spec.minimum is not None:
            out.append((value < spec.minimum, f"less than {spec.minimum}"))
        if spec.maximum is not None:
            out.append((value > spec.maximum, f"more than {spec.maximum}"))
        if spec.max_decimal is not None:
            out.append((F.round(value, spec.max_decimal) != value,
                        f"more than {spec.max_decimal} decimal places"))
    if isinstance(data, T.ArrayType):
        if spec.min_items is not None:
            out.append((F.size(value) < spec.min_items,
                        f"fewer than {spec.min_items} items"))
        if spec.max_items is not None:
            out.append((F.size(value) > spec.max_items,
                        f"more than {spec.max_items} items"))
        if spec.items is not None:
            for i, (_, message) in enumerate(_checks(F.lit(None).cast(data.elementType),
                                                     data.elementType, spec.items)):
                def fails(item: Column, i: int = i) -> Column:
                    return _checks(item, data.elementType, spec.items)[i][0]

                out.append((F.exists(value, _unary(fails)), f"an item is {message}"))
    if spec.enum:
        out.append((~value.isin(list(spec.enum)),
                    "none of " + ", ".join(str(v) for v in spec.enum)))
    return out


def _unary(fn):
    return lambda item: fn(item)


def schema_errors(df: DataFrame, spec: Mapping[str, Property], key: str) -> DataFrame:
    """(key, property, message) for every violation, found in one pass over the table."""
    found = []
    for name, prop in spec.items():
        value, data = F.col(name), df.schema[name].dataType
        if not prop.optional:
            found.append(F.when(value.isNull(), _error(name, "absent")))
        for fails, message in _checks(value, data, prop):
            found.append(F.when(value.isNotNull() & fails, _error(name, message)))
    errors = F.filter(F.array(*found), lambda e: e.isNotNull())
    return df.select(F.col(key), F.explode(errors).alias("_e")).select(
        key, F.col("_e.property").alias("property"), F.col("_e.message").alias("message"))


def _error(name: str, message: str) -> Column:
    return F.struct(F.lit(name).alias("property"), F.lit(message).alias("message"))


def schema_conformance(df: DataFrame, spec: Mapping[str, Property], key: str) -> DataFrame:
    """(property, message, n) over the whole table."""
    return schema_errors(df, spec, key).groupBy("property", "message").agg(
        F.count(F.lit(1)).alias("n"))


def cross_field_errors(df: DataFrame, key: str, required: Mapping[str, Column] = {},
                       depends: Mapping[str, Sequence[str]] = {},
                       confirms: Mapping[str, str] = {}) -> DataFrame:
    """(key, field, problem) for rules between the fields of a record.

    ``required``: a field that must be filled where the condition holds.  ``depends``: a field that
    may be filled only if all the others are.  ``confirms``: a field that must repeat another.  A
    string of blanks is not filled.
    """
    def filled(name: str) -> Column:
        return F.col(name).isNotNull() & (F.trim(F.col(name).cast("string")) != "")

    def problem(name: str, text: str) -> Column:
        return F.struct(F.lit(name).alias("field"), F.lit(text).alias("problem"))

    found = [F.when(F.coalesce(cond, F.lit(False)) & ~filled(name), problem(name, "required"))
             for name, cond in required.items()]
    for name, others in depends.items():
        for other in others:
            found.append(F.when(filled(name) & ~filled(other), problem(name, f"needs {other}")))
    for name, other in confirms.items():
        found.append(F.when(~F.col(name).eqNullSafe(F.col(other)), problem(name, f"is not {other}")))
    errors = F.filter(F.array(*found), lambda e: e.isNotNull())
    return df.select(key, F.explode(errors).alias("_e")).select(key, "_e.field", "_e.problem")


def content_fingerprints(df: DataFrame, text: str) -> DataFrame:
    """md5, sha1 and sha2 of a text column."""
    return df.withColumn("md5", F.md5(text)).withColumn("sha1", F.sha1(text)).withColumn(
        "sha256", F.sha2(text, 256))


def exact_duplicates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(sha256, copies, first_key) of every text that occurs more than once."""
    prints = df.select(key, F.sha2(text, 256).alias("sha256"))
    return prints.groupBy("sha256").agg(
        F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_key")).filter("copies > 1")
